"""Which data readers see: an append-only log of commits.

A write fills a folder of its own and touches nothing that is there. A commit is
one small file, written after everything it names is whole; it appears as a whole
or not at all, and readers follow the newest one. So a write that fails, or is
killed, leaves readers what they had, and several layers appear at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files
from .layout import LOG, is_attempt, log_path, new_commit_id

_COUNTS = "map<string,bigint>"
_TABLE = f"struct<layer:string,target:string,folder:string,rows:bigint,checks:{_COUNTS},types:{_COUNTS}>"
COMMIT_SCHEMA = f"commit string, committed_at timestamp, run_id string, tables array<{_TABLE}>"


@dataclass(frozen=True)
class Written:
    """A table that is written but not yet published.

    ``target`` is the place readers ask for, ``folder`` the one that has the data;
    ``checks`` are numbers taken while writing, ``types`` rows per type.
    """

    layer: str
    target: str
    folder: str
    rows: int
    checks: Mapping[str, int] = field(default_factory=dict)
    types: Mapping[str, int] = field(default_factory=dict)


def _counts(values: Mapping[str, int]) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return (F.create_map(*pairs) if pairs else F.create_map()).cast(_COUNTS)


def commit(spark: SparkSession, log: str, tables: Sequence[Written], run_id: str | None = None) -> str:
    """Publish tables that are whole, all at once; return the commit's id."""
    name = new_commit_id()
    listed = F.array(
        *(
            F.struct(
                F.lit(t.layer).alias("layer"),
                F.lit(t.target).alias("target"),
                F.lit(t.folder).alias("folder"),
                F.lit(t.rows).cast("bigint").alias("rows"),
                _counts(t.checks).alias("checks"),
                _counts(t.types).alias("types"),
            )
            for t in tables
        )
    )
    record = spark.range(0, 1, 1, 1).select(
        F.lit(name).alias("commit"),
        F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp").alias("committed_at"),
        F.lit(run_id).cast("string").alias("run_id"),
        listed.alias("tables"),
    )
    # A folder for each, so that commits made at the same time do not meet.
    record.write.json(f"{log}/{name}")
    return name


def commits(spark: SparkSession, log: str) -> DataFrame:
    """The log, one row per commit. It has no rows if nothing was ever published."""
    if not files.exists(spark, log):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", True).json(log)


def published(spark: SparkSession, target: str) -> str | None:
    """The folder with what was last published at ``target``; None without a log.

    Raises ``FileNotFoundError`` if there is a log but nothing of this place in it.
    """
    target = target.rstrip("/")
    log = log_path(target)
    if not files.exists(spark, log):
        return None
    named = commits(spark, log).select("commit", F.inline("tables")).where(F.col("target") == target)
    newest = named.agg(F.max_by("folder", "commit")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"nothing is published at {target}")
    return newest


def published_runs(spark: SparkSession, base: str) -> DataFrame:
    """The catalogue of a lake: one row per layer of every published run.

    ``(run_id, commit, committed_at, newest, layer, folder, rows, checks, types)``. Of a
    run id that was repeated the last commit counts; ``newest`` marks the run that was
    committed last. It is read from the log alone, which has a row per run.
    """
    log = commits(spark, f"{base.rstrip('/')}/{LOG}").where("run_id is not null")
    by_commit = Window.partitionBy("run_id").orderBy(F.col("commit").desc())
    last = log.withColumn("place", F.row_number().over(by_commit)).where("place = 1")
    last = last.withColumn("newest", F.col("commit") == log.agg(F.max("commit")).scalar())
    return last.select("run_id", "commit", "committed_at", "newest", F.inline("tables")).drop("target")


def discard(spark: SparkSession, tables: Sequence[Written]) -> None:
    """Remove the data of tables that will not be published."""
    for table in tables:
        files.delete(spark, table.folder)


def remove_unpublished(spark: SparkSession, target: str) -> int:
    """Delete the data at a place that readers no longer see; return how many writes' data.

    What was replaced, and what writes left that were killed. For a time when nothing
    is being written there and nobody still reads what was replaced.
    """
    target = target.rstrip("/")
    kept = published(spark, target)
    old = [n for n in files.children(spark, target) if is_attempt(n) and f"{target}/{n}" != kept]
    for name in old:
        files.delete(spark, f"{target}/{name}")
    return len(old)
