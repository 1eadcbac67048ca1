"""Contract checks that decide whether rows may enter the clean layer."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import REQUIRED_COLUMNS, TRANSACTION_TYPES
from ..functions import outside_domain


class InvalidTypeError(ValueError):
    """Rows carry transaction types outside the domain.

    ``rows`` and ``types`` are totals; ``report`` is the complete table of types
    and their row counts, which may be of any size and so is not collected.
    """

    def __init__(self, rows: int, types: int, report: DataFrame):
        super().__init__(f"invalid transaction types: {types} types in {rows} rows")
        self.rows, self.types, self.report = rows, types, report


def assert_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Return ``df`` if it has every required column; looks at the schema only."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def invalid_type_report(df: DataFrame, domain: Sequence[str] = TRANSACTION_TYPES) -> DataFrame:
    """Rows per type outside the domain. A null type is not reported."""
    return df.where(outside_domain(domain=domain)).groupBy("type").count()


def assert_domain(df: DataFrame, domain: Sequence[str] = TRANSACTION_TYPES) -> DataFrame:
    """Return ``df`` if no row has a type outside the domain, else raise.

    Costs one job that reads only ``type``, and fetches two totals. The error's
    ``report`` lists every type when it is read.
    """
    report = invalid_type_report(df, domain)
    totals = report.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    if totals[1]:
        raise InvalidTypeError(*totals, report)
    return df


def split_valid(
    df: DataFrame, domain: Sequence[str] = TRANSACTION_TYPES
) -> tuple[DataFrame, DataFrame]:
    """Split into rows that pass the gate and rows to quarantine.

    Every input row is in exactly one part; a null type passes.
    """
    stray = F.coalesce(outside_domain(domain=domain), F.lit(False))
    return df.where(~stray), df.where(stray)
