"""Structured Streaming entry points."""

from strata.streaming.ingest import read_registers, stream_dedup, stream_ingest, stream_upsert

__all__ = ["read_registers", "stream_dedup", "stream_ingest", "stream_upsert"]
