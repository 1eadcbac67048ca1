"""Lazy DataFrame operators."""

from .balance import balance_consistency, balance_discrepancies, flag_balance
from .cleaning import clean, drop_duplicate_rows, duplicate_report, fill_missing
from .expectations import (
    METRIC_EXPECTATIONS,
    TRANSACTION_EXPECTATIONS,
    Expectation,
    between,
    broken_counts,
    broken_expectations,
    in_set,
    not_null,
    passes,
    run_expectations,
    split_by_expectations,
)
from .gate import (
    InvalidTypeError,
    assert_columns,
    assert_domain,
    invalid_type_report,
    split_valid,
)
from .history import (
    DIGEST,
    digest_text,
    digests,
    drop_known_digests,
    drop_known_rows,
    row_digest,
    with_digests,
)
from .median import median_by_key
from .metrics import (
    merge_states,
    metric_states,
    metrics_of_states,
    share_of_total,
    type_metrics,
)
from .profile import NO_TYPE, OTHER_TYPE, distinct_types, ingest_profile, quarantine_counts, type_counts

__all__ = [
    "DIGEST",
    "METRIC_EXPECTATIONS",
    "NO_TYPE",
    "OTHER_TYPE",
    "TRANSACTION_EXPECTATIONS",
    "Expectation",
    "InvalidTypeError",
    "assert_columns",
    "assert_domain",
    "balance_consistency",
    "balance_discrepancies",
    "between",
    "broken_counts",
    "broken_expectations",
    "clean",
    "digest_text",
    "digests",
    "distinct_types",
    "drop_duplicate_rows",
    "drop_known_digests",
    "drop_known_rows",
    "duplicate_report",
    "fill_missing",
    "flag_balance",
    "in_set",
    "ingest_profile",
    "invalid_type_report",
    "median_by_key",
    "merge_states",
    "metric_states",
    "metrics_of_states",
    "not_null",
    "passes",
    "quarantine_counts",
    "row_digest",
    "run_expectations",
    "share_of_total",
    "split_by_expectations",
    "split_valid",
    "type_counts",
    "type_metrics",
    "with_digests",
]
