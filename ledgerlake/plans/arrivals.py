"""The layered job on files as they arrive: every batch of a file stream is a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..contracts import Ledger
from .medallion import DEFAULT, MALFORMED, run_medallion


def run_arrivals(
    spark: SparkSession,
    source: str,
    base: str,
    checkpoint: str,
    name: str = "arrivals",
    ledger: Ledger = DEFAULT,
    files_per_batch: int = 1000,
    quarantine: bool = False,
    **options,
) -> list[str]:
    """Run the job on the CSV files below ``source`` that no batch has taken yet; return the run ids.

    Ends when all files that were there at the start are taken. The stream's
    ``checkpoint`` remembers which; it and ``name`` belong to one stream. A batch is a
    published run of the lake ``base`` whose id follows from its number, so a batch that is
    repeated after a failure replaces itself and counts once. Rows that an earlier
    batch has cleaned do not enter again, and batches keep their states: the metrics of
    all that arrived are :func:`..plans.metrics_over_runs`. The digests of earlier batches
    take the place of a stream's own state, so nothing is held between batches and
    a row may arrive again however late.

    Further ``options`` are :func:`run_medallion`'s. A batch that fails its gates stops the
    stream; its files are taken again the next time.
    """
    schema = ledger.schema
    reader = spark.readStream.option("header", True).option("maxFilesPerTrigger", files_per_batch)
    if quarantine:
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    done: list[str] = []

    def run(batch: DataFrame, number: int) -> None:
        run_id = f"{name}-{number:010d}"
        run_medallion(
            batch.sparkSession, batch, base, run_id, ledger=ledger, quarantine=quarantine,
            once=True, keep_states=True, **options,
        )
        done.append(run_id)

    stream = reader.schema(schema).csv(source).writeStream.foreachBatch(run)
    stream = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    stream.start().awaitTermination()
    return done
