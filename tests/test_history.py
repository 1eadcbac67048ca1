"""Rows of earlier deliveries, catalogue and routing."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlake import operators as op
from ledgerlake import plans
from ledgerlake.operators import history
from ledgerlake.sources import published_runs, read_run
from tests.test_medallion import source  # noqa: F401 - a fixture
from tests.test_sources import GOOD

KIND = "a int, b double, c string"
ROWS = [
    (1, 1.0, "x"), (1, 1.0, None), (1, None, "x"), (None, None, None), (1, math.nan, "x"),
    (1, 0.0, "x"), (1, -0.0, "x"), (2, 1.0, "x"), (1, 1.0, "null"), (1, 1.0, ""), (1, 1.0, 'x","c":"y'),
]


def test_digests_follow_row_equality(spark):
    df = spark.createDataFrame(ROWS, KIND)
    assert op.digests(df).count() == df.distinct().count() == len(ROWS) - 1


@pytest.mark.parametrize("bits", [2**29, 0])
def test_known_rows_are_dropped_exactly(spark, monkeypatch, bits):
    monkeypatch.setattr(history, "MOST_BITS", bits)
    old = [(i, i / 7, f"s{i % 13}") for i in range(3000)]
    new = [(i, i / 7 if i % 5 else None, f"s{i % 13}") for i in range(2000, 6000)] * 2
    known = op.digests(spark.createDataFrame(old, KIND))
    df = spark.createDataFrame(new, KIND).repartition(5)
    got = sorted(map(tuple, op.drop_known_rows(df, known, 8000).collect()), key=repr)
    assert got == sorted((r for r in new if r not in set(old)), key=repr)
    assert op.drop_known_rows(df, known.limit(0), 8000).count() == 8000
    assert op.drop_known_rows(df.limit(0), known, 0).count() == 0


def test_filter_leaves_little_of_the_known_rows(spark):
    """Before the shuffle, about a row in 32 is left of those that do not match."""
    new = op.digests(spark.range(1000).selectExpr("id", "'new' as s"))
    known = op.digests(spark.range(50_000).selectExpr("id", "'old' as s"))
    left = history._filtered(known.unionByName(new), new, 2**15)
    assert 1000 <= left.count() < 1000 + 50_000 / 20


def test_each_side_is_shuffled_once(spark):
    """Known rows that are not far more are not filtered, which would cost as much again."""
    new = spark.range(1000).selectExpr("id", "'new' as s")
    known = spark.createDataFrame([("ab" * 32,)], f"{history.DIGEST} string").repartition(2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for known_rows, exchanges, bitmaps in ((4000, 2, False), (4001, 3, True)):
            left = op.drop_known_rows(new, known, 1000, known_rows)
            plan = left._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == exchanges
            assert ("bitmap_construct_agg" in plan) == bitmaps
            assert left.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_run_takes_digests_once(spark, source, tmp_path, monkeypatch):  # noqa: F811
    """Both layers made from the new rows come from one pass, of which nothing is left."""
    base, lines = str(tmp_path / "lake"), [GOOD, GOOD, GOOD.replace("310.5", "5.0")]
    taken, real = [], plans.medallion.with_digests
    monkeypatch.setattr(plans.medallion, "with_digests", lambda df: taken.append(df) or real(df))
    plans.run_medallion(spark, source(*lines), base, "r1", once=True)
    plans.run_medallion(spark, source(*lines, GOOD.replace("310.5", "")), base, "r2", once=True)
    assert len(taken) == 2
    for run_id, rows in (("r1", 2), ("r2", 1)):
        digests = read_run(spark, base, "digests", run_id)
        own = op.digests(read_run(spark, base, "bronze", run_id))
        assert digests.count() == rows and digests.dtypes == own.dtypes
        assert digests.join(own, history.DIGEST).count() == rows
        assert len(list((tmp_path / "lake" / "digests" / f"run_id={run_id}").iterdir())) == 1
    assert [r["amount"] for r in read_run(spark, base, "silver", "r2").collect()] == [0.0]


def test_second_delivery_of_a_file_adds_nothing(spark, source, tmp_path):  # noqa: F811
    base, first = str(tmp_path / "lake"), source(GOOD, GOOD, GOOD.replace("310.5", "5.0"))
    run = plans.run_medallion(spark, first, base, "r1", once=True)
    assert run.silver.rows == 2
    again = plans.run_medallion(spark, first, base, "r2", once=True)
    assert (again.bronze.rows, again.silver.rows, again.gold.rows) == (3, 0, 0)
    # The same run once more is no later delivery.
    assert plans.run_medallion(spark, first, base, "r1", once=True).silver.rows == 2
    more = source(GOOD, GOOD.replace("310.5", "6.0"))
    third = plans.run_medallion(spark, more, base, "r3", once=True)
    assert [r["amount"] for r in read_run(spark, base, "silver").collect()] == [6.0]
    assert third.silver.rows == 1
    # A run that fails is not remembered.
    fourth = source(GOOD.replace("310.5", "-7.0"))
    with pytest.raises(plans.ChecksFailed):
        plans.run_medallion(spark, fourth, base, "r4", once=True, clean_gate=op.TRANSACTION_EXPECTATIONS)
    assert plans.run_medallion(spark, fourth, base, "r5", once=True).silver.rows == 1
    assert {r["run_id"] for r in published_runs(spark, base).collect()} == {"r1", "r2", "r3", "r5"}


def test_routing(spark, source, tmp_path):  # noqa: F811
    lines = [GOOD, GOOD.replace("310.5", "-1.0").replace("PAYMENT", "X"), GOOD.replace("PAYMENT", ""), GOOD.replace("310.5", "n/a")]
    suite = op.TRANSACTION_EXPECTATIONS
    run = plans.run_medallion(spark, source(*lines), str(tmp_path / "a"), "r", quarantine=True, route=suite)
    aside = spark.read.parquet(run.silver.quarantined.path).collect()
    assert sorted(r[plans.REASONS] for r in aside) == sorted([
        ["invalid type", "type in_set", "amount between"], ["type not_null"], ["malformed line", "amount not_null"],
    ])
    assert (run.bronze.rows, run.silver.rows) == (4, 1) and run.bronze.checks["routed_rows"] == 3
    assert plans.REASONS not in spark.read.parquet(run.silver.path).columns
    counts = {r["type"]: tuple(r)[2:] for r in plans.rows_by_type(spark, str(tmp_path / "a")).collect()}
    assert counts["PAYMENT"] == (2, 1, 0, 1) and counts[op.OTHER_TYPE] == (1, 1, 0, 0)
    assert counts[op.NO_TYPE] == (1, 1, 0, 0) and counts["DEBIT"] == (0, 0, 0, 0)
    with pytest.raises(ValueError, match="quarantine"):
        plans.run_medallion(spark, source(GOOD), str(tmp_path / "b"), route=suite)
    with pytest.raises(ValueError, match="another routing"):
        bronze = plans.ingest_layer(spark, source(GOOD), str(tmp_path / "bronze"))
        plans.clean_layer(spark, bronze.path, str(tmp_path / "c"), checked=bronze, quarantine=str(tmp_path / "q"), route=suite)


def test_split_by_expectations(frame):
    df = frame(("PAYMENT", 1.0, 1.0, 1.0), ("X", -1.0, 1.0, 1.0), (None, None, 1.0, 1.0))
    good, bad = op.split_by_expectations(df)
    assert [r["type"] for r in good.collect()] == ["PAYMENT"] and good.columns == df.columns
    assert {r["type"]: r["broken"] for r in bad.collect()} == {
        "X": ["type in_set", "amount between"],
        None: ["type not_null", "amount not_null"],
    }
    assert op.split_by_expectations(df, [])[0].count() == 3


def test_states_add_up(spark):
    from testtables import transactions

    df = op.clean(transactions(spark, "/root/testdata/sf0.001"))
    parts = [df.where(F.col("step") % 3 == i) for i in range(3)]
    states = op.metric_states(parts[0])
    for part in parts[1:]:
        states = states.unionByName(op.metric_states(part))
    names = [c for c in op.type_metrics(df, "approx").columns if c != "median_amount_k"]
    got = {tuple(r) for r in op.metrics_of_states(states).select(*names).collect()}
    assert got == {tuple(r) for r in op.type_metrics(df, "approx").select(*names).collect()}
