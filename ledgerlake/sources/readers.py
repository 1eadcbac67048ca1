"""Sources: CSV under the transaction contract, and stored layers."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import TRANSACTION_SCHEMA
from .commits import published, published_runs
from .files import first_lines


def _lenient(skip_unreadable: bool) -> dict[str, bool]:
    return {"ignoreMissingFiles": skip_unreadable, "ignoreCorruptFiles": skip_unreadable}


def read_transactions_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = TRANSACTION_SCHEMA,
    strict_header: bool = False,
    corrupt_column: str | None = None,
    skip_unreadable: bool = False,
    by_name: bool = False,
) -> DataFrame:
    """Read CSV with a header line under an explicit schema; nothing is inferred.

    Columns bind by position, or with ``by_name`` by each file's own header
    (:func:`_read_by_name`). Cells that fail their cast become null and short
    lines are padded with nulls. ``strict_header`` fails on a header that does
    not match the schema. ``corrupt_column`` adds a column with the raw text of
    every malformed line. ``skip_unreadable`` skips missing and corrupt files,
    which loses their rows silently.
    """
    if by_name:
        if strict_header:
            raise ValueError("columns bind by name or under a strict header, not both")
        return _read_by_name(spark, path, schema, corrupt_column, skip_unreadable)
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    reader = spark.read.schema(schema).options(
        header=True, enforceSchema=not strict_header, **_lenient(skip_unreadable)
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def _read_by_name(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    corrupt_column: str | None,
    skip_unreadable: bool,
) -> DataFrame:
    """Files with headers of their own: columns in any order, some missing, others more.

    The header of every file is read first, and files of equal headers are one scan. A
    column of the schema that a header lacks is null, one that the schema lacks is left
    out; names are compared as they are. A header that names a column twice is an
    error, and a file without any line has no rows. A line is malformed under its own
    file's header.
    """
    files: dict[str, list[str]] = {}
    for name, line in sorted(first_lines(spark, path).items()):
        if line is not None:
            files.setdefault(line, []).append(name)
    types = {f.name: f.dataType for f in schema.fields}
    parts = []
    for line, names in files.items():
        header = next(csv.reader([line.removeprefix("\ufeff")]))
        twice = sorted({c for c in header if header.count(c) > 1})
        if twice:
            raise ValueError(f"{names[0]}: the header names {', '.join(twice)} more than once")
        # Names that the schema lacks may differ from its names in case only.
        own = [c if c in types else f"_other_{i}" for i, c in enumerate(header)]
        fields = [T.StructField(c, types.get(c, T.StringType())) for c in own]
        if corrupt_column:
            fields.append(T.StructField(corrupt_column, T.StringType()))
        reader = spark.read.schema(T.StructType(fields)).options(
            header=True, enforceSchema=True, **_lenient(skip_unreadable)
        )
        if corrupt_column:
            # Without the columns left out, a line that lacks their cells would seem whole.
            reader = reader.options(columnNameOfCorruptRecord=corrupt_column, columnPruning=False)
        there = reader.csv(names)
        columns = [
            F.col(c) if c in own else F.lit(None).cast(kind).alias(c) for c, kind in types.items()
        ]
        parts.append(there.select(*columns, *([corrupt_column] if corrupt_column else [])))
    if not parts:
        more = [T.StructField(corrupt_column, T.StringType())] if corrupt_column else []
        return spark.createDataFrame([], T.StructType([*schema.fields, *more]))
    return reduce(DataFrame.unionByName, parts)


def read_layer(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    skip_unreadable: bool = False,
) -> DataFrame:
    """Read a stored layer, or several as one.

    Of a place that :func:`..sources.write_layer` or a run has written, what was
    last published there; any other folder as it is. The schema comes from one file
    unless it is given, which it should be if that file may be an unreadable one.
    """
    reader = spark.read.options(**_lenient(skip_unreadable))
    paths = [path] if isinstance(path, str) else path
    folders = [published(spark, p) or p for p in paths]
    return (reader.schema(schema) if schema else reader).parquet(*folders)


def read_run(
    spark: SparkSession, base: str, layer: str, run_id: str | None = None
) -> DataFrame:
    """A layer of one run of the lake ``base``: of the newest that was published, or of ``run_id``.

    Runs that failed, or were killed, have published nothing and are never found.
    """
    runs = published_runs(spark, base).where(F.col("layer") == layer)
    if run_id is not None:
        runs = runs.where(F.col("run_id") == run_id)
    found = runs.agg(F.max_by("folder", "commit")).first()[0]
    if found is None:
        raise FileNotFoundError(f"no published run of {base} has {layer} of {run_id or 'any run'}")
    return spark.read.parquet(found)
