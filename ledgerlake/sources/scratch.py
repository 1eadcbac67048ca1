"""A folder for intermediate tables that every executor can read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from .files import make_until_end

_own: list[str] = []


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new path below ``spark.checkpoint.dir``, deleted when Spark ends.

    A session of this machine alone (``local[n]``) may leave the setting out and
    gets a temporary folder. On a cluster that is an error: what one executor
    writes to its own disk the others cannot read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="ledgerlake-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        base = _own[0]
    folder = f"{base.rstrip('/')}/ledgerlake-{name}-{uuid.uuid4().hex}"
    return f"{make_until_end(spark, folder)}/{name}"
