"""Pure DataFrame -> DataFrame operators."""

from strata.operators.checks import (
    check_not_null,
    check_rerun,
    check_scd2,
    check_unique,
    duplicate_keys,
    fanout_report,
    table_digest,
    unresolved_keys,
)
from strata.operators.dims import (
    calendar_dim,
    calendar_for,
    scd1_dim,
    scd2_apply,
    scd2_changes,
    scd2_has_changes,
    scd2_init,
    scd2_merge,
)
from strata.operators.facts import asof_scan, asof_version_join, build_fact, ratio_pct, resolve_keys, star_report
from strata.operators.history import append_history, as_of, change_history_summary, change_log, retention_candidates
from strata.operators.merge import DuplicateKeyError, classify_changes, merge_summary, upsert
from strata.operators.metrics import (
    at_risk,
    distinct_sketches,
    double_decline,
    grain_safe_join,
    merge_sketches,
    period_change,
    rollup_metrics,
    sketch_counts,
    top_groups,
    vs_population,
)
from strata.operators.partitions import (
    merge_partitions,
    overwrite_impact,
    replace_partitions,
    replace_where,
    spread_for_write,
    write_partitions,
)
from strata.operators.privacy import mask_columns
from strata.operators.register import event_register, merge_registers, register_state
from strata.operators.skew import heavy_hitters, plain_aggregate, salted_aggregate, skew_report
from strata.operators.state import consolidate_state, dedup_exact, forward_fill, latest_by_key, source_priority

__all__ = [n for n in dir() if not n.startswith("_")]
