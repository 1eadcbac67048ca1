"""Sizing shuffles from row counts that are already known."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: About 1 GB of transactions in memory, a few hundred MB once shuffled.
ROWS_PER_PARTITION = 8_000_000

_PARTITIONS = "spark.sql.shuffle.partitions"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """Partitions for shuffling ``rows`` whole rows."""
    return max(1, -(-rows // rows_per_partition))


def sized_session(
    spark: SparkSession, rows: int, rows_per_partition: int = ROWS_PER_PARTITION
) -> SparkSession:
    """A session with enough shuffle partitions for ``rows`` rows.

    Adaptive execution merges partitions that turn out small but does not split
    those of an aggregate, so the number to start from must grow with the data.
    It changes how many tasks there are, never the result. The caller's session
    is returned if its settings suffice; else a session of its own with the
    caller's settings and raised numbers, so that nothing else is planned with
    them.
    """
    needed = shuffle_partitions(rows, rows_per_partition)
    settings = {name: spark.conf.get(name, None) or "" for name in (_PARTITIONS, _INITIAL)}
    raised = [name for name, value in settings.items() if value.isdigit() and int(value) < needed]
    if not raised:
        return spark
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    for name in raised:
        session.conf.set(name, needed)
    return session
