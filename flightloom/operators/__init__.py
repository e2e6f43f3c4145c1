from flightloom.operators.quality import (
    cast_to,
    drop_tombstones,
    is_missing,
    reason_counts,
    reject_non_numeric,
    with_reject_reason,
)
from flightloom.operators.relational import (
    collapse_samples,
    dedupe_keys,
    enrich_join,
    equals,
    in_periods,
    in_periods_of,
    max_offset,
    preview,
    rekey,
    select_columns,
    unique_records,
)

__all__ = [
    "cast_to",
    "collapse_samples",
    "dedupe_keys",
    "drop_tombstones",
    "enrich_join",
    "equals",
    "in_periods",
    "in_periods_of",
    "is_missing",
    "max_offset",
    "preview",
    "reason_counts",
    "reject_non_numeric",
    "rekey",
    "select_columns",
    "unique_records",
    "with_reject_reason",
]
