"""Row de-duplication and null filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import FEE_RULES, FILLED_COLUMNS, FeeRule
from .balance import flag_balance
from .gate import assert_columns


def drop_duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep one of each set of equal rows.

    Each task first drops its own copies, so a row that makes up a third of the
    table reaches the shuffle once per task. ``subset`` compares (and shuffles)
    fewer columns and keeps an arbitrary row per key, which is another result.
    """
    return df.dropDuplicates(list(subset) if subset else None)


def fill_missing(df: DataFrame, columns: Sequence[str] = FILLED_COLUMNS) -> DataFrame:
    """Replace null and NaN by 0 in ``columns``."""
    return assert_columns(df, columns).na.fill(0, list(columns))


def clean(
    df: DataFrame, keep_flags: bool = False, rules: Sequence[FeeRule] = FEE_RULES
) -> DataFrame:
    """Drop duplicate rows, then fill missing amounts and balances.

    The fill comes last, so rows that differ only by null and 0 both stay and
    end up equal. ``keep_flags`` adds ``balance_check`` as it stood before the
    fill; it depends on the row alone, so it is computed after the shuffle.
    """
    unique = drop_duplicate_rows(assert_columns(df))
    return fill_missing(flag_balance(unique, rules) if keep_flags else unique)


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: all rows, distinct rows, and rows that repeat another."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_rows"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))
