"""Scans, the batch log and snapshot tables (the storage-touching layer)."""

from strata.sources.evolve import BatchLog, SchemaConflictError, conform, evolve_union, ingest_batches, select_tolerant
from strata.sources.files import normalize, read_batch, read_typed
from strata.sources.table import BrokenContract, Table, committed, path_exists

__all__ = [
    "BatchLog", "SchemaConflictError", "conform", "evolve_union", "ingest_batches", "select_tolerant", "normalize",
    "read_batch", "read_typed", "BrokenContract", "Table", "committed", "path_exists",
]
