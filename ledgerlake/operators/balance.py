"""Balance rules: per-row labels, their summary, and the arithmetic check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import BALANCE_TOLERANCE, FEE_RULES, VALID_LABEL, FeeRule
from ..functions import balance_drift, balance_label


def flag_balance(df: DataFrame, rules: Sequence[FeeRule] = FEE_RULES) -> DataFrame:
    """Add ``balance_check``: the broken fee rule's label, or ``valid``."""
    return df.withColumn("balance_check", balance_label(rules))


def balance_discrepancies(df: DataFrame, rules: Sequence[FeeRule] = FEE_RULES) -> DataFrame:
    """Rows per type and broken rule."""
    flagged = flag_balance(df, rules).where(F.col("balance_check") != VALID_LABEL)
    return flagged.groupBy("type", "balance_check").count()


def balance_consistency(
    df: DataFrame, type: str = "PAYMENT", tolerance: float = BALANCE_TOLERANCE
) -> DataFrame:
    """Check that new balance = old balance - amount on every row of a type.

    One row ``(evaluated, unexpected, success)``. A missing operand counts as
    unexpected; a table without such rows succeeds.
    """
    holds = F.coalesce(balance_drift() < F.lit(tolerance), F.lit(False))
    return (
        df.where(F.col("type") == type)
        .agg(F.count("*").alias("evaluated"), F.count_if(~holds).alias("unexpected"))
        .withColumn("success", F.col("unexpected") == 0)
    )
