"""Row-level business rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import FEE_RULES, TRANSACTION_TYPES, VALID_LABEL, FeeRule


def outside_domain(column: str = "type", domain: Sequence[str] = TRANSACTION_TYPES) -> Column:
    """True for a value outside the domain, false inside it, null for null."""
    return ~F.col(column).isin(*domain)


def balance_drift() -> Column:
    """How far the sender's new balance is from old balance minus amount."""
    return F.abs(F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig"))


def balance_label(rules: Sequence[FeeRule] = FEE_RULES) -> Column:
    """The label of the first fee rule a row breaks, else ``valid``.

    A null operand makes the comparison null, which breaks no rule; a NaN
    compares greater than any number, so it does.
    """
    label = F.lit(VALID_LABEL)
    for rule in reversed(rules):
        exceeded = balance_drift() > F.col("amount") * F.lit(rule.rate)
        label = F.when((F.col("type") == rule.type) & exceeded, rule.label).otherwise(label)
    return label
