"""Files and folders on any file system that Spark can reach."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Files whose first lines are read at the same time.
_READERS = 32


def _of(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _of(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all in it; one that is not there is no error."""
    system, where = _of(spark, path)
    system.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    system, where = _of(spark, path)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def make_until_end(spark: SparkSession, path: str) -> str:
    """Make a folder that is deleted when Spark ends; return its full name."""
    system, where = _of(spark, path)
    system.mkdirs(where)
    system.deleteOnExit(where)
    return where.toString()


def first_lines(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, str | None]:
    """The first line of every file below ``paths``, by full name; None of an empty file.

    Spark lists the files; the driver opens each, many at a time, and reads one line.
    Compressed files are read by the codec that their name stands for.
    """
    listed = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
    names = [r["path"] for r in listed.select("path").collect()]
    java = spark._jvm.java.io
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())

    def first(name: str) -> str | None:
        system, where = _of(spark, name)
        stream = system.open(where)
        try:
            codec = codecs.getCodec(where)
            read = codec.createInputStream(stream) if codec else stream
            return java.BufferedReader(java.InputStreamReader(read, "UTF-8")).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(_READERS) as pool:
        return dict(zip(names, pool.map(first, names), strict=True))
