"""Declarative data-quality expectations, evaluated in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import TRANSACTION_TYPES
from .gate import assert_columns


@dataclass(frozen=True)
class Expectation:
    """A condition on the cells of one column, held as plain values.

    ``not_null`` looks at all cells, the others at those that are not null:
    ``in_set`` wants one of ``values``, ``between`` a cell within the bounds that
    are given. Two expectations that ask for the same are equal.
    """

    name: str
    column: str
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    strict_max: bool = False

    def violated(self) -> Column:
        """Whether a cell is unexpected; false or null if it is not."""
        cell = F.col(self.column)
        if self.name == "not_null":
            return cell.isNull()
        if self.name == "in_set":
            return ~cell.isin(*self.values)
        low, high = self.min_value, self.max_value
        outside = F.lit(False)
        if low is not None:
            outside = outside | (cell <= low if self.strict_min else cell < low)
        if high is not None:
            outside = outside | (cell >= high if self.strict_max else cell > high)
        return outside

    @property
    def label(self) -> str:
        return f"{self.column} {self.name}"

    def evaluated_count(self) -> Column:
        return F.count(F.lit(1) if self.name == "not_null" else F.col(self.column))

    def unexpected_count(self) -> Column:
        return F.count_if(self.violated())

    def unexpected_values(self, most: int, tracked: int) -> Column:
        """An aggregate: the most frequent unexpected values and their rows."""
        value = F.when(self.violated(), F.col(self.column).cast("string"))
        # All other cells are null, which the sketch counts as a value of its own.
        found = F.call_function("approx_top_k", value, F.lit(most + 1), F.lit(tracked))
        named = F.filter(found, lambda x: x["item"].isNotNull())
        return F.transform(
            F.slice(named, 1, most), lambda x: F.struct(x["item"].alias("value"), x["count"].alias("rows"))
        ).cast("array<struct<value:string,rows:bigint>>")


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def in_set(column: str, values: Sequence) -> Expectation:
    return Expectation("in_set", column, values=tuple(values))


def between(
    column: str,
    min_value: float | None = None,
    max_value: float | None = None,
    strict_min: bool = False,
    strict_max: bool = False,
) -> Expectation:
    """Cells within the given bounds; a bound left out does not apply."""
    if min_value is None and max_value is None:
        raise ValueError("between needs min_value or max_value")
    return Expectation("between", column, (), min_value, max_value, strict_min, strict_max)


def broken_expectations(suite: Sequence[Expectation]) -> Column:
    """The expectations that a row breaks, as an array of names in the suite's order."""
    named = (F.when(e.violated(), F.lit(e.label)) for e in suite)
    return F.array_compact(F.array(*named)) if suite else F.array().cast("array<string>")


def split_by_expectations(
    df: DataFrame, suite: Sequence[Expectation] | None = None, reasons: str = "broken"
) -> tuple[DataFrame, DataFrame]:
    """Rows that break no expectation, and the others with what they break.

    Every row is in exactly one part. ``reasons`` names the column that the second
    part has in addition.
    """
    suite = TRANSACTION_EXPECTATIONS if suite is None else suite
    flagged = assert_columns(df, {e.column for e in suite}).withColumn(
        reasons, broken_expectations(suite)
    )
    return flagged.where(F.size(reasons) == 0).drop(reasons), flagged.where(F.size(reasons) > 0)


def broken_counts(df: DataFrame, reasons: str = "broken") -> DataFrame:
    """Rows per set of reasons: ``(reasons, rows)`` for the second part of a split."""
    return df.groupBy(reasons).agg(F.count("*").alias("rows"))


TRANSACTION_EXPECTATIONS = (
    not_null("type"),
    in_set("type", TRANSACTION_TYPES),
    not_null("amount"),
    between("amount", min_value=0, strict_min=True),
)

METRIC_EXPECTATIONS = (
    between("transaction_count", min_value=0, strict_min=True),
    between("percentage_of_total", min_value=0, max_value=100, strict_min=True),
    between("avg_amount_k", min_value=0, strict_min=True),
)


RESULT_SCHEMA = (
    "expectation string, column string, evaluated bigint, unexpected bigint, success boolean"
)
EXAMPLES_SCHEMA = "array<struct<value:string,rows:bigint>>"

#: Different values that a sketch of unexpected ones tracks, for each expectation.
TRACKED = 10_000


def run_expectations(
    df: DataFrame,
    suite: Sequence[Expectation] = TRANSACTION_EXPECTATIONS,
    examples: int = 0,
    tracked: int = TRACKED,
) -> DataFrame:
    """One row per expectation: evaluated and unexpected cells, and success.

    The whole suite is a single aggregate over the columns it names. An empty
    suite gives no rows. With ``examples`` there is a further column of that name: so
    many of the most frequent unexpected values, as text, and their rows, from the
    largest count down. They come from a sketch in the same aggregate, which is exact
    up to about ``tracked`` different values and of a fixed size beyond; a missing
    cell has no value, so ``not_null`` has no examples.
    """
    assert_columns(df, {e.column for e in suite})
    if not suite:
        extra = f", examples {EXAMPLES_SCHEMA}" if examples else ""
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA + extra)
    frequent = [e.unexpected_values(examples, tracked) for e in suite] if examples else []
    counts = df.agg(
        *(e.evaluated_count().alias(f"evaluated_{i}") for i, e in enumerate(suite)),
        *(e.unexpected_count().alias(f"unexpected_{i}") for i, e in enumerate(suite)),
        *(values.alias(f"examples_{i}") for i, values in enumerate(frequent)),
    )
    results = F.array(
        *(
            F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit(e.column).alias("column"),
                F.col(f"evaluated_{i}").alias("evaluated"),
                F.col(f"unexpected_{i}").alias("unexpected"),
                (F.col(f"unexpected_{i}") == 0).alias("success"),
                *([F.col(f"examples_{i}").alias("examples")] if examples else []),
            )
            for i, e in enumerate(suite)
        )
    )
    return counts.select(F.inline(results))


def passes(df: DataFrame, suite: Sequence[Expectation] = TRANSACTION_EXPECTATIONS) -> bool:
    """Whether every expectation of the suite holds."""
    return run_expectations(df, suite).where("not success").isEmpty()
