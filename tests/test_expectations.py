import pytest

from ledgerlake import operators as op


def results(df, suite=op.TRANSACTION_EXPECTATIONS):
    return {(r["expectation"], r["column"]): tuple(r)[2:] for r in op.run_expectations(df, suite).collect()}


def test_valid_rows_pass(frame):
    df = frame(
        ("DEBIT", 3.5, 8.0, 4.5),
        ("CASH_IN", 71.0, 0.0, 71.0),
        ("PAYMENT", 0.01, 44.0, 43.99),
    )
    assert op.passes(df)
    assert all(success for _, _, success in results(df).values())


@pytest.mark.parametrize(
    "row",
    [
        ("VOUCHER", 6.0, 9.0, 3.0),
        (None, 6.0, 9.0, 3.0),
        ("CASH_IN", None, 9.0, 3.0),
        ("CASH_IN", 0.0, 9.0, 3.0),
        ("CASH_IN", -6.0, 9.0, 3.0),
    ],
)
def test_one_bad_cell_fails_the_suite(frame, row):
    assert not op.passes(frame(("DEBIT", 1.0, 2.0, 1.0), row))


def test_nulls_are_outside_the_scope_of_value_checks(frame):
    df = frame((None, None, 1.0, 1.0), ("REFUND", -1.0, 1.0, 1.0), ("DEBIT", 1.0, 1.0, 1.0))
    assert results(df) == {
        ("not_null", "type"): (3, 1, False),
        ("in_set", "type"): (2, 1, False),
        ("not_null", "amount"): (3, 1, False),
        ("between", "amount"): (2, 1, False),
    }


def test_empty_table_passes(frame):
    df = frame(("DEBIT", 1.0, 2.0, 1.0)).limit(0)
    assert set(results(df).values()) == {(0, 0, True)}
    assert op.passes(df)


def test_empty_suite_gives_no_rows(frame):
    df = frame(("DEBIT", 1.0, 2.0, 1.0))
    assert op.run_expectations(df, ()).collect() == []
    assert op.run_expectations(df, ()).dtypes == op.run_expectations(df).dtypes
    assert op.passes(df, ())


def test_expectations_compare_by_what_they_ask_for():
    assert op.between("x", 0, 5) == op.between("x", 0, 5)
    assert op.between("x", 0, 5) != op.between("x", 0, 5, strict_max=True)
    assert op.in_set("x", ["a"]) == op.in_set("x", ("a",)) != op.in_set("x", ["b"])


def test_bounds(spark):
    df = spark.createDataFrame([(0.0,), (50.0,), (100.0,), (None,)], "x double")
    cases = {
        op.between("x", 0, 100): 0,
        op.between("x", 0, 100, strict_min=True): 1,
        op.between("x", 0, 100, strict_max=True): 1,
        op.between("x", 0, 100, strict_min=True, strict_max=True): 2,
        op.between("x", max_value=49): 2,
        op.between("x", min_value=51): 2,
    }
    got = [r.unexpected for r in op.run_expectations(df, list(cases)).collect()]
    assert got == list(cases.values())
    with pytest.raises(ValueError):
        op.between("x")


def test_unknown_column_is_an_error(frame):
    with pytest.raises(ValueError, match="missing columns: fee"):
        op.run_expectations(frame(("DEBIT", 1.0, 2.0, 1.0)), [op.not_null("fee")])


def test_suite_is_one_aggregate_over_its_columns(spark, frame, tmp_path):
    path = str(tmp_path / "layer")
    frame(("DEBIT", 1.0, 2.0, 1.0)).write.parquet(path)
    plan = op.run_expectations(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<type:string,amount:double>" in plan


def test_metric_sanity(spark):
    schema = "transaction_count bigint, percentage_of_total double, avg_amount_k double"
    good = spark.createDataFrame([(1, 100.0, 0.5)], schema)
    bad = spark.createDataFrame([(1, 100.0, 0.5), (0, 100.5, 0.0)], schema)
    assert op.passes(good, op.METRIC_EXPECTATIONS)
    assert [r.unexpected for r in op.run_expectations(bad, op.METRIC_EXPECTATIONS).collect()] == [1, 1, 1]


def test_examples_of_unexpected_values(spark, frame):
    rows = [("X", -1.0, 1.0, 1.0)] * 3 + [("y", 1.0, 1.0, 1.0)] + [(None, None, 1.0, 1.0)] * 9 + [("PAYMENT", 1.0, 1.0, 1.0)] * 50
    report = {
        (r["column"], r["expectation"]): [tuple(x) for x in r["examples"]]
        for r in op.run_expectations(frame(*rows), examples=2).collect()
    }
    assert report == {
        ("type", "not_null"): [],
        ("type", "in_set"): [("X", 3), ("y", 1)],
        ("amount", "not_null"): [],
        ("amount", "between"): [("-1.0", 3)],
    }
    one = op.run_expectations(frame(*rows), examples=1).collect()
    assert [len(r["examples"]) for r in one] == [0, 1, 0, 1]
    empty = op.run_expectations(frame(("X", 1.0, 1.0, 1.0)).limit(0), examples=3).collect()
    assert all(r["examples"] == [] and r["success"] for r in empty)
    assert op.run_expectations(frame(*rows), [], examples=1).columns[-1] == "examples"
    # Far more values than are tracked: the report stays small, the counts of cells exact.
    many = spark.range(50_000).selectExpr("concat('t', id) as type", "1.0D as amount")
    found = op.run_expectations(many, [op.in_set("type", ["a"])], examples=5, tracked=64).first()
    assert found["unexpected"] == 50_000 and len(found["examples"]) <= 5
