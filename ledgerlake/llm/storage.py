"""Intermediate tables and arrays in the folder that all executors share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..sources import files, scratch_path


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share; see :func:`..sources.scratch_path`."""
    return scratch_path(spark, "llm")


#: Rows that an executor hands to a Python worker at a time where each has a whole text.
TEXT_ROWS = 512
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def few_rows(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """What is run meanwhile hands at most ``rows`` rows at a time to Python workers.

    A batch lies in the memory of the executor and of the worker besides the heap, and with
    Spark's default it has all texts of a task. Afterwards the setting is the caller's again.
    """
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, rows if int(before) <= 0 else min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def stored(df: DataFrame, texts: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: work that several readers need is done once, and a lost
    executor costs no more than reading the table again. ``texts`` tells that Python
    workers get whole texts or sets to make it.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    with few_rows(spark) if texts else nullcontext():
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def release(spark: SparkSession, *tables) -> None:
    """Delete stored tables, and stores with a ``folder``, that nothing will read again.

    Only once every result made from them is stored itself.
    """
    for table in tables:
        if hasattr(table, "stored_at"):
            files.delete(spark, table.stored_at)
        elif hasattr(table, "folder"):
            files.delete(spark, f"file:{table.folder}")  # a mounted one


def mounted_folder(spark: SparkSession) -> str:
    """A new shared folder as a plain path, for arrays that workers map to memory."""
    folder = shared_folder(spark)
    path = plain_path(folder)
    if path is None:
        raise ValueError(f"arrays can be mapped only in a mounted folder, not in {folder}")
    os.makedirs(path, exist_ok=True)
    return path


def plain_path(folder: str) -> str | None:
    """A folder's path on this machine; None if it is on another file system."""
    scheme, colon, rest = folder.partition(":")
    if not colon or "/" in scheme:
        return folder
    return "/" + rest.lstrip("/") if scheme == "file" else None


def is_mounted(spark: SparkSession) -> bool:
    """Whether workers can map arrays in the shared folder to memory."""
    return plain_path(shared_folder(spark)) is not None


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array so that a repeated or concurrent attempt leaves a whole file."""
    path = f"{folder}/{name}.npy"
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as file:
        np.save(file, array)
    os.replace(part, path)


def map_array(folder: str, name: str) -> np.ndarray:
    """A stored array, mapped to memory: pages are read when they are looked at."""
    path = f"{folder}/{name}.npy"
    if os.path.getsize(path) <= 128:  # an empty array can't be mapped
        return np.load(path)
    return np.load(path, mmap_mode="r")
