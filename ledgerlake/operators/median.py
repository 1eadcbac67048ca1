"""Exact lower median per key without gathering a key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bin_span, linear_bin, log_bin

#: Keys a closed domain may have: its bins are broadcast, a row per key.
MAX_DOMAIN = 10_000
#: Parts over which the open path spreads the values of one bin.
SALTS = 16

# A coarse bin is 1/256 wide, relative to its values; it is cut into fine bins.
_COARSE_PER_E_FOLD = 256
_FINE = 65_536


def median_by_key(
    df: DataFrame,
    key: str,
    value: str,
    domain: Sequence[str] | None = None,
    salts: int = SALTS,
    sums: Sequence[Column] = (),
) -> DataFrame:
    """The lower median of ``value`` per key: ``(key, median)``.

    The median is an actual value, the smallest one with at least half of the
    key's non-null values at or below it. It is found by narrowing: count the
    values per coarse bin, keep only the bin that holds the middle rank, count
    the distinct values in there, cut the range they span into fine bins, and
    rank only the values of the bin that holds the middle. A single task orders
    a key's bins, whose number is fixed, and the distinct values of one fine
    bin. Copies of a value are combined before every shuffle.

    With a closed ``domain`` a key that is neither in it nor null fails the job,
    so the chosen bins are at most ``len(domain) + 1`` rows and are broadcast:
    ``df`` is then read twice and the bulk of it never shuffled. Without one the
    number of keys is unknown, so distinct values are shuffled, and the bins are
    joined to them by a shuffle in which a key's bin is spread over ``salts``
    parts by a hash of the values.

    Keys without any non-null value are left out.

    ``sums`` are named aggregates over ``df`` that can be added up over parts of it.
    They are taken together with the counts per coarse bin, so they cost no scan
    of their own, and are returned per key as further columns; then every key is
    in the result, with a null median if it has no value. For a closed domain.
    """
    closed = domain is not None
    if sums and not closed:
        raise ValueError("sums need a closed domain")
    if closed and len(domain) > MAX_DOMAIN:
        raise ValueError(f"a closed domain has at most {MAX_DOMAIN} keys; leave it out")
    names = F.array(*(F.lit(name) for name in domain)) if closed else None
    rows = df.select(
        (_place(key, names) if closed else F.col(key)).alias("key"),
        F.col(value).alias("value"),
        F.col(value).isNotNull().cast("bigint").alias("n"),
    )
    if not closed:
        rows = _sum_counts(rows, "key", "value")

    def in_chosen(rows: DataFrame, chosen: DataFrame, bin: Column, span: int) -> DataFrame:
        """Rows of each key's chosen bin, which they take their rank from."""
        if closed:
            # Places are numbers, so place and bin match as one number.
            chosen = F.broadcast(chosen.withColumn("chosen", F.col("key") * span + F.col("bin")))
            match = F.col("key") * span + bin == F.col("chosen")
            return rows.join(chosen.drop("key", "bin"), match).drop("chosen")
        chosen = chosen.withColumnsRenamed({"key": "of_key", "bin": "chosen"})
        chosen = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        part = F.pmod(F.xxhash64("value"), F.lit(salts))
        match = F.col("key").eqNullSafe(F.col("of_key")) & (bin == F.col("chosen"))
        return rows.join(chosen, match & (part == F.col("part"))).drop("of_key", "chosen", "part")

    coarse_bin = log_bin(F.col("value"), _COARSE_PER_E_FOLD)
    if sums:
        coarse = df.groupBy(_place(key, names).alias("key"), log_bin(F.col(value), _COARSE_PER_E_FOLD).alias("bin"))
        coarse = coarse.agg(
            F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), *sums
        )
        coarse = _all_needed(coarse)
    else:
        coarse = rows.groupBy("key", coarse_bin.alias("bin")).agg(
            F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
    middle = F.ceil(F.sum("n").over(Window.partitionBy("key")) / 2)
    chosen = _holding_rank(coarse.withColumn("rank", middle), "bin")
    near = in_chosen(rows, chosen, coarse_bin, bin_span(_COARSE_PER_E_FOLD))
    if closed:
        of_key = (F.any_value(name).alias(name) for name in ("rank", "low", "high"))
        near = near.groupBy("key", "value").agg(F.sum("n").alias("n"), *of_key)
        # True everywhere; it makes both readers below need the same columns, so
        # that the second one reuses the shuffle.
        near = near.where(F.col("rank") > 0)

    fine_bin = linear_bin(F.col("value"), F.col("low"), F.col("high"), _FINE)
    fine = _sum_counts(near.withColumn("bin", fine_bin), "key", "rank", "bin")
    nearest = in_chosen(near.drop("rank"), _holding_rank(fine, "bin"), fine_bin, _FINE + 1)

    name = F.col("key")
    if closed:
        name = F.when(name > 0, F.element_at(names, name.cast("int")))
    found = _holding_rank(nearest, "value").select("key", F.col("value").alias("median"))
    if not sums:
        return found.select(name.alias(key), "median")
    added = [c for c in coarse.columns if c not in ("key", "bin", "n", "low", "high")]
    totals = coarse.groupBy("key").agg(*(F.sum(c).alias(c) for c in added))
    medians = F.broadcast(found.withColumnRenamed("key", "of_key"))  # a row per key
    totals = totals.join(medians, F.col("key") == F.col("of_key"), "left")
    return totals.select(name.alias(key), "median", *added)


def _all_needed(coarse: DataFrame) -> DataFrame:
    """A filter that is always true and looks at every column, so that all readers
    need the same ones and share one scan and shuffle."""
    return coarse.where(F.size(F.array(*(F.col(c).cast("double") for c in coarse.columns))) > 0)


def _place(key: str, names: Column) -> Column:
    """The key's place among the names, 0 for null; fails the job on another key."""
    place = F.array_position(names, F.col(key))
    error = F.concat(F.lit(f"{key} outside the given domain: "), F.col(key))
    return F.when(place == 0, F.raise_error(error)).otherwise(F.coalesce(place, F.lit(0)))


def _sum_counts(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"))


def _holding_rank(counts: DataFrame, order: str) -> DataFrame:
    """Per key, keep the row whose ``n`` values hold the value ranked ``rank``.

    ``rank`` then counts from the first value of that row. Null values count 0,
    so their row holds no rank.
    """
    ordered = Window.partitionBy("key").orderBy(order)
    upto = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rank, before = F.col("rank"), F.col("before")
    held = counts.withColumn("before", upto - F.col("n"))
    held = held.where((rank > before) & (rank <= before + F.col("n")))
    return held.withColumn("rank", rank - before).drop("before", "n")
