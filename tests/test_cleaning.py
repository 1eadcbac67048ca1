import math
import random

import pytest

from ledgerlake import operators as op
from tests.conftest import SHORT_SCHEMA

NAN = float("nan")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_valid_rows_stay(frame):
    df = frame(("CASH_IN", 12.5, 3.0, 15.5), ("DEBIT", 7.0, 31.0, 24.0))
    assert rows(op.clean(df)) == rows(df)
    assert op.clean(df).schema.names == df.schema.names


def test_equal_rows_collapse(frame):
    row = ("DEBIT", 1.0, 2.0, 1.0)
    assert rows(op.clean(frame(row, row, row))) == [row]


def test_signed_zero_and_nan_compare_equal(frame):
    zeros = op.clean(frame(("DEBIT", 0.0, 2.0, 1.0), ("DEBIT", -0.0, 2.0, 1.0)))
    nans = op.drop_duplicate_rows(frame(("DEBIT", NAN, 2.0, 1.0), ("DEBIT", NAN, 2.0, 1.0)))
    assert (zeros.count(), nans.count()) == (1, 1)


def test_null_and_zero_copies_survive_and_become_equal(frame):
    df = frame(("DEBIT", None, 2.0, 1.0), ("DEBIT", 0.0, 2.0, 1.0), ("DEBIT", 0.0, 2.0, 1.0))
    assert rows(op.clean(df)) == [("DEBIT", 0.0, 2.0, 1.0)] * 2


def test_fill_covers_null_and_nan_of_three_columns_only(spark):
    schema = "type string, amount double, oldbalanceOrg double, newbalanceOrig double, oldbalanceDest double"
    df = spark.createDataFrame([(None, NAN, None, NAN, None), (None, None, NAN, None, NAN)], schema)
    cleaned = op.clean(df).collect()
    assert all(tuple(r)[:4] == (None, 0.0, 0.0, 0.0) for r in cleaned)
    dest = [r.oldbalanceDest for r in cleaned]
    assert None in dest and any(v is not None and math.isnan(v) for v in dest)


def test_flags_can_be_kept_and_predate_the_fill(frame):
    df = frame(
        ("PAYMENT", 64.0, 90.0, 13.0),
        ("PAYMENT", None, 200.0, 50.0),
        ("PAYMENT", 64.0, 90.0, 13.0),
    )
    flagged = op.clean(df, keep_flags=True)
    assert rows(flagged) == [
        ("PAYMENT", 0.0, 200.0, 50.0, "valid"),
        ("PAYMENT", 64.0, 90.0, 13.0, "payment_fee_exceeded"),
    ]
    assert rows(flagged.drop("balance_check")) == rows(op.clean(df))


def test_dropping_by_subset_is_separate(frame):
    df = frame(("DEBIT", 1.0, 2.0, 1.0), ("DEBIT", 5.0, 2.0, 1.0))
    assert op.drop_duplicate_rows(df).count() == 2
    assert op.drop_duplicate_rows(df, ["type"]).count() == 1


def test_missing_column_fails_before_any_job(spark):
    with pytest.raises(ValueError, match="missing columns"):
        op.clean(spark.createDataFrame([("PAYMENT", 1.0)], "type string, amount double"))


def test_duplicate_report(frame):
    a, b = ("DEBIT", 1.0, 2.0, 1.0), (None, None, None, None)
    report = op.duplicate_report(frame(a, a, b, b, b)).first().asDict()
    assert report == {"total_rows": 5, "distinct_rows": 2, "duplicate_rows": 3}
    report = op.duplicate_report(frame(a).limit(0)).first().asDict()
    assert report == {"total_rows": 0, "distinct_rows": 0, "duplicate_rows": 0}


def test_copies_combine_before_the_shuffle(frame):
    plan = op.clean(frame(("DEBIT", 1.0, 2.0, 1.0)))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange") == 1
    assert "HashAggregate" in plan[:exchange] and "HashAggregate" in plan[exchange:]


def test_against_brute_force(spark):
    """Many small tables in one job, told apart by a further column."""
    rng = random.Random(8)
    cells, types = [None, NAN, 0.0, -0.0, 1.5], [None, "DEBIT", "PAYMENT"]
    table = [
        (rng.choice(types), *rng.choices(cells, k=3), rng.randrange(300)) for _ in range(12_000)
    ]
    # A marker makes NaN equal to itself; Python's zeros are equal already.
    unique = {tuple("nan" if c != c else c for c in row) for row in table}
    filled = [
        (row[0], *(0.0 if c in (None, "nan") else c for c in row[1:4]), row[4]) for row in unique
    ]
    df = spark.createDataFrame(table, f"{SHORT_SCHEMA}, number int")
    got = [(r[0], *(c + 0.0 for c in r[1:])) for r in op.clean(df).collect()]
    assert sorted(map(repr, got)) == sorted(repr((t, *(c + 0.0 for c in r))) for t, *r in filled)
