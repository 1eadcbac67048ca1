"""Sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import files
from .commits import Written, commit
from .layout import attempt_path, log_path

_ROWS, _TYPES = "rows", "rows per type"


def stage_layer(
    df: DataFrame,
    target: str,
    checks: Mapping[str, Column] | None = None,
    layer: str = "table",
    types: Column | None = None,
) -> Written:
    """Write ``df`` as Parquet for ``target`` without publishing it.

    ``checks`` are aggregates over the written rows, ``types`` one with a map of
    counts. They and the row count are taken by the tasks that write, in the job's
    last stage, where Spark counts every partition once however often a lost one is
    run again. Nothing is read a second time. A write that fails leaves no data.
    """
    taken = Observation()
    more = [check.alias(name) for name, check in (checks or {}).items()]
    if types is not None:
        more.append(types.alias(_TYPES))
    folder = attempt_path(target)
    try:
        df.observe(taken, F.count(F.lit(1)).alias(_ROWS), *more).write.parquet(folder)
    except BaseException:
        files.delete(df.sparkSession, folder)
        raise
    seen = dict(taken.get)
    return Written(layer, target.rstrip("/"), folder, seen.pop(_ROWS), types=seen.pop(_TYPES, {}), checks=seen)


def write_layer(
    df: DataFrame, path: str, checks: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Replace what :func:`..sources.read_layer` finds at ``path`` by ``df``; return ``rows``
    and the checks, see :func:`stage_layer`.

    Readers see the old rows until all new ones are stored, and keep them if that
    fails. ``df`` may itself be read from ``path``.
    """
    written = stage_layer(df, path, checks)
    commit(df.sparkSession, log_path(path), [written])
    return {_ROWS: written.rows, **written.checks}
