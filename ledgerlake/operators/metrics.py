"""Business metrics per transaction type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import LARGE_AMOUNT, METRIC_COLUMNS, SKETCH_ACCURACY
from .gate import assert_columns
from .median import median_by_key


#: Groups of scan tasks whose sketches are merged apart.
MERGES = 64


def over_all(count: str) -> Column:
    """The sum over all rows, which brings them to one task: for few groups."""
    return F.sum(count).over(Window.partitionBy())


def share_of_total(
    counts: DataFrame, count: str = "transaction_count", total: Column | None = None
) -> DataFrame:
    """Add ``percentage_of_total`` to a table that has one row per group.

    Without a ``total`` it is summed in a subquery, so that any number of groups
    may occur; for a closed domain :func:`over_all` sums the few groups in place.
    """
    if total is None:
        total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn("percentage_of_total", F.round(F.col(count) / total * 100, 2))


def _sums(large_amount: float) -> list[Column]:
    """What the metrics are made of; every one can be added up over parts."""
    amount, old, new = F.col("amount"), F.col("oldbalanceOrg"), F.col("newbalanceOrig")
    change = (new - old) / F.when(old != 0, old).otherwise(1) * 100
    return [
        F.count("*").alias("transaction_count"),
        F.count(amount).alias("amounts"),
        F.sum(amount / 1000).alias("sum_amount_k"),
        F.sum(amount).alias("sum_amount"),
        F.count(change).alias("changes"),
        F.sum(change).alias("sum_change"),
        F.count_if(old == 0).alias("zero_balance_count"),
        F.sum(old).alias("sum_balance"),
        F.count_if(amount > large_amount).alias("large"),
    ]


def _finished(sums: DataFrame) -> DataFrame:
    """Metrics of each type from its sums."""
    # Scale and number of digits of every metric.
    return sums.select(
        *(c for c in ("type", "median") if c in sums.columns),
        "transaction_count",
        F.round(F.try_divide("sum_amount_k", "amounts"), 2).alias("avg_amount_k"),
        F.round(F.col("sum_amount") / 1_000_000, 3).alias("total_volume_m"),
        F.round(F.try_divide("sum_change", "changes"), 2).alias("avg_balance_change_pct"),
        "zero_balance_count",
        # Null where a type's balances sum to 0.
        F.round(F.try_divide("sum_amount", "sum_balance"), 4).alias("volume_to_balance_ratio"),
        F.round(F.col("large") / F.col("transaction_count") * 100, 2).alias("large_txn_ratio_pct"),
    )


def metric_states(
    df: DataFrame, large_amount: float = LARGE_AMOUNT, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """What the metrics are made of, one row per type, in a form that can be added up.

    Sums, and in column ``sketch`` a quantile sketch of the amounts; NaN amounts are left
    out of it. States of parts of a table, put under each other, give the metrics of
    all of it by :func:`metrics_of_states`. Scan tasks are dealt to ``MERGES`` groups whose
    sketches are merged first, so no task merges the sketches of all scan tasks.
    """
    sketch = F.kll_sketch_agg_double("amount", accuracy).alias("sketch")
    part = F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("part")
    parts = assert_columns(df).groupBy("type", part).agg(*_sums(large_amount), sketch)
    return merge_states(parts.drop("part"), accuracy)


def merge_states(states: DataFrame, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Add up states of the same type; again one row per type."""
    added = [c for c in states.columns if c not in ("type", "sketch")]
    return states.groupBy("type").agg(
        *(F.sum(c).alias(c) for c in added),
        F.kll_merge_agg_double("sketch", accuracy).alias("sketch"),
    )


def metrics_of_states(states: DataFrame, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """The metrics table of everything whose states are in the rows, however many per type."""
    metrics = _with_median(_of_states(merge_states(states, accuracy)))
    return share_of_total(metrics, total=over_all("transaction_count")).select(*METRIC_COLUMNS)


def _of_states(merged: DataFrame) -> DataFrame:
    median = F.when(
        F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))
    )
    return _finished(merged.withColumn("median", median))


def _with_median(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("median_amount_k", F.round(F.col("median") / 1000, 2))


def type_metrics(
    df: DataFrame,
    median: str = "exact",
    domain: Sequence[str] | None = None,
    large_amount: float = LARGE_AMOUNT,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """The metrics table: one row per type, columns as in ``METRIC_COLUMNS``.

    ``median="approx"`` adds quantile sketches of size ``accuracy`` to the same
    aggregate: one scan, and a value whose rank is nearly the middle one (about
    0.13 % off at the default size); see :func:`metric_states`.

    The exact plan reads ``df`` twice, so store it first if it is expensive.

    Give ``domain`` if ``df`` has passed the gate for it. The exact median then
    needs no shuffle of the table, and fails on a type outside the domain; the
    total is taken from the groups instead of a second count of the rows.
    """
    if median not in ("exact", "approx"):
        raise ValueError(f"median must be 'exact' or 'approx', not {median!r}")
    assert_columns(df)

    if median == "approx":
        metrics = _of_states(metric_states(df, large_amount, accuracy))
    elif domain is not None:
        sums = _sums(large_amount)
        metrics = _finished(median_by_key(df, "type", "amount", domain, sums=sums))
    else:
        medians = median_by_key(df, "type", "amount").withColumnRenamed("type", "median_type")
        metrics = _finished(df.groupBy("type").agg(*_sums(large_amount)))
        same_type = F.col("type").eqNullSafe(F.col("median_type"))
        metrics = metrics.join(medians, same_type, "left")

    metrics = _with_median(metrics)
    # Any number of types may occur without a domain: count rows in a subquery.
    total = df.agg(F.count("*")).scalar() if domain is None else over_all("transaction_count")
    return share_of_total(metrics, total=total).select(*METRIC_COLUMNS)

