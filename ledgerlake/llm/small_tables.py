"""Joins with tables that are usually small, and ranks without a hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows up to which a stored table is broadcast.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcast if counting shows that it is small.

    A larger one stays unmarked and is joined by a shuffle.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def gapless_rank(
    df: DataFrame, group: str, order: list[str], rank: str, rows_per_part: int = 10_000
) -> DataFrame:
    """Number the rows of each group from 0, as bigint column ``rank``.

    ``df`` should be stored: it is read three times. A group is cut into parts
    of about ``rows_per_part`` rows by a hash of the ``order`` columns; parts are
    numbered within themselves and start where the ones before them end, so a
    group of any size is spread over tasks. Rows equal in ``order`` lie in one
    part and are numbered in any order.
    """
    parts = df.groupBy(F.col(group).alias("of_group")).agg(
        F.ceil(F.count("*") / rows_per_part).cast("int").alias("of_parts")
    )
    same = F.col(group).eqNullSafe(F.col("of_group"))
    part = F.pmod(F.xxhash64(*order), F.col("of_parts")).cast("int")
    cut = df.join(small(parts), same).withColumn("of_part", part).drop("of_group", "of_parts")
    counted = cut.groupBy(F.col(group).alias("of_group"), F.col("of_part").alias("in_part")).agg(
        F.count("*").alias("part_rows")
    )
    before = Window.partitionBy("of_group").orderBy("in_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counted.select(
        "of_group", "in_part", F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rank_start")
    )
    within = Window.partitionBy(group, "of_part").orderBy(*order)
    numbered = cut.withColumn("in_rank", F.row_number().over(within))
    return (
        numbered.join(
            starts,
            F.col(group).eqNullSafe(F.col("of_group")) & (F.col("of_part") == F.col("in_part")),
        )
        .withColumn(rank, F.col("rank_start") + F.col("in_rank") - 1)
        .drop("of_group", "of_part", "in_part", "in_rank", "rank_start")
    )


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
