"""Reports over the published runs of a lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import SKETCH_ACCURACY
from ..operators import metrics_of_states
from ..sources import published_runs


def _chosen(runs: DataFrame, run_ids: Sequence[str] | None) -> DataFrame:
    return runs if run_ids is None else runs.where(F.col("run_id").isin(*run_ids))


def rows_by_type(
    spark: SparkSession, base: str, run_ids: Sequence[str] | None = None
) -> DataFrame:
    """What became of the rows of every type: one row per published run and type.

    ``(run_id, type, rows_in, quarantined, duplicates, rows_out)``: rows ingested, set
    aside, dropped as copies of others, and cleaned; the last three add up to the
    first. The counts were taken while the layers were written, so no layer is read.
    Types outside the domain are counted together.
    """
    counts = _chosen(published_runs(spark, base), run_ids).select(
        "run_id", "layer", F.explode("types").alias("type", "n")
    )

    def of(layer: str):
        return F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col("n"))), F.lit(0)).alias(layer)

    rows = counts.groupBy("run_id", "type").agg(of("bronze"), of("quarantine"), of("silver"))
    return rows.select(
        "run_id",
        "type",
        F.col("bronze").alias("rows_in"),
        F.col("quarantine").alias("quarantined"),
        (F.col("bronze") - F.col("quarantine") - F.col("silver")).alias("duplicates"),
        F.col("silver").alias("rows_out"),
    )


def metrics_over_runs(
    spark: SparkSession,
    base: str,
    run_ids: Sequence[str] | None = None,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """The metrics of all rows of several published runs, from their stored states.

    Of all runs that kept states, or of ``run_ids``; nothing but the states is read,
    a row per run and type. A row that two runs have counts twice. The median has a
    rank error like that of one sketch over all rows.
    """
    runs = _chosen(published_runs(spark, base).where("layer = 'states'"), run_ids)
    # A path per run: as many as there are commits to list.
    folders = [r["folder"] for r in runs.select("folder").collect()]
    if not folders:
        raise FileNotFoundError(f"no published run of {base} kept its states")
    return metrics_of_states(spark.read.parquet(*folders), accuracy)
