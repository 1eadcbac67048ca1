"""Small whole-table reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import TRANSACTION_TYPES
from ..functions import outside_domain


def distinct_types(df: DataFrame) -> DataFrame:
    """The types that occur."""
    return df.select("type").distinct()


def quarantine_counts(df: DataFrame, domain: Sequence[str] = TRANSACTION_TYPES) -> DataFrame:
    """One row: all rows, rows that pass the gate, rows to quarantine."""
    counts = df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(outside_domain(domain=domain)).alias("quarantined_rows"),
    )
    return counts.withColumn("passing_rows", F.col("total_rows") - F.col("quarantined_rows"))


def ingest_profile(df: DataFrame) -> DataFrame:
    """One row that reads every column of an ingested table.

    Null counts show cells that were missing or failed their cast; a bare row
    count would not parse a single cell.
    """
    return df.agg(
        F.count("*").alias("total_rows"),
        *(F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in df.columns),
    )


#: Names under which rows without a type, and rows of any type not listed, are counted.
NO_TYPE, OTHER_TYPE = "(null)", "(other)"


def type_counts(types: Sequence[str] = TRANSACTION_TYPES) -> Column:
    """An aggregate: a map of the rows per type.

    It has an entry for each of ``types``, one for null and one for all other types
    together, so its size is known whatever the column holds.
    """
    kind = F.col("type")
    counts = [(t, F.count_if(kind == t)) for t in types]
    counts += [
        (NO_TYPE, F.count_if(kind.isNull())),
        (OTHER_TYPE, F.count_if(~kind.isin(*types))),
    ]
    return F.create_map(*(x for name, n in counts for x in (F.lit(name), n)))
