import pytest

from ledgerlake import operators as op
from ledgerlake.contracts import METRIC_COLUMNS, TRANSACTION_TYPES
from ledgerlake.operators.metrics import over_all

PLANS = [
    {"median": "exact", "domain": TRANSACTION_TYPES},
    {"median": "exact"},
    {"median": "approx"},
]


@pytest.fixture(params=PLANS, ids=["exact-closed", "exact-open", "approx"])
def metrics(request):
    def run(df):
        result = op.type_metrics(df, **request.param)
        return {r["type"]: r for r in result.collect()}

    return run


def test_two_equal_payments(frame, metrics):
    row = ("PAYMENT", 3000.0, 12000.0, 9000.0)
    got = metrics(frame(row, row))
    assert got["PAYMENT"].asDict() == {
        "type": "PAYMENT",
        "transaction_count": 2,
        "avg_amount_k": 3.0,
        "total_volume_m": 0.006,
        "median_amount_k": 3.0,
        "avg_balance_change_pct": -25.0,
        "zero_balance_count": 0,
        "volume_to_balance_ratio": 0.25,
        "large_txn_ratio_pct": 0.0,
        "percentage_of_total": 100.0,
    }


def test_column_order_and_types(frame):
    result = op.type_metrics(frame(("CASH_IN", 470.0, 30.0, 500.0)))
    assert tuple(result.columns) == METRIC_COLUMNS
    kinds = dict(result.dtypes)
    assert kinds.pop("type") == "string"
    assert kinds.pop("transaction_count") == kinds.pop("zero_balance_count") == "bigint"
    assert set(kinds.values()) == {"double"}


def test_groups_and_shares(frame, metrics):
    df = frame(*[("DEBIT", 1.0, 2.0, 1.0)] * 2, ("CASH_IN", 1.0, 2.0, 1.0))
    shares = {k: r.percentage_of_total for k, r in metrics(df).items()}
    assert shares == {"DEBIT": 66.67, "CASH_IN": 33.33}


def test_zero_balances(frame, metrics):
    df = frame(("DEBIT", 100.0, 0.0, 0.5), ("DEBIT", 100.0, 0.0, 0.0))
    row = metrics(df)["DEBIT"]
    assert row.zero_balance_count == 2
    assert row.avg_balance_change_pct == 25.0  # divided by 1 instead of 0
    assert row.volume_to_balance_ratio is None


def test_balances_that_cancel_out(frame, metrics):
    df = frame(("DEBIT", 100.0, 5.0, 5.0), ("DEBIT", 100.0, -5.0, -5.0))
    assert metrics(df)["DEBIT"].volume_to_balance_ratio is None


def test_large_is_strictly_above_the_threshold(frame, metrics):
    df = frame(*(("DEBIT", a, 1.0, 1.0) for a in (10000.0, 10000.01, 5.0, 20000.0)))
    assert metrics(df)["DEBIT"].large_txn_ratio_pct == 50.0
    assert op.type_metrics(df, large_amount=1).first().large_txn_ratio_pct == 100.0


def test_median_of_even_count_is_the_lower_value(frame, metrics):
    df = frame(*(("DEBIT", a, 1.0, 1.0) for a in (4000.0, 1000.0, 3000.0, 2000.0)))
    assert metrics(df)["DEBIT"].median_amount_k == 2.0


def test_null_type_and_null_amounts(frame, metrics):
    df = frame((None, None, 2.0, 1.0), (None, None, 2.0, 1.0), ("DEBIT", 3000.0, 2.0, 1.0))
    got = metrics(df)
    assert got[None].transaction_count == 2
    assert got[None].median_amount_k is None and got[None].avg_amount_k is None
    assert got["DEBIT"].median_amount_k == 3.0


def test_empty_table(frame, metrics):
    assert metrics(frame(("DEBIT", 1.0, 2.0, 1.0)).limit(0)) == {}


def test_types_outside_the_domain(frame):
    df = frame(("REFUND", 1000.0, 2.0, 1.0), ("DEBIT", 3000.0, 2.0, 1.0))
    for median in ("exact", "approx"):
        got = {r.type: r.median_amount_k for r in op.type_metrics(df, median).collect()}
        assert got == {"REFUND": 1.0, "DEBIT": 3.0}
    with pytest.raises(Exception, match="type outside the given domain: REFUND"):
        op.type_metrics(df, domain=TRANSACTION_TYPES).collect()


def test_unknown_median_is_an_error(frame):
    with pytest.raises(ValueError, match="median"):
        op.type_metrics(frame(("DEBIT", 1.0, 2.0, 1.0)), median="mean")


def test_share_of_total(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 3)], "g string, n bigint")
    for total in (None, over_all("n")):
        shares = {r.g: r.percentage_of_total for r in op.share_of_total(counts, "n", total).collect()}
        assert shares == {"a": 25.0, "b": 75.0}
    # The default does not bring the groups to one task.
    assert "Window" not in op.share_of_total(counts, "n")._jdf.queryExecution().toString()


def test_sketch_is_near_the_middle_rank(spark):
    # 2 000 000 different amounts: the sketch can't hold them all.
    df = spark.range(0, 2_000_000, 1, 70).selectExpr(
        "'DEBIT' as type", "double((id * 7919) % 2000000) as amount",
        "1d as oldbalanceOrg", "1d as newbalanceOrig",
    )
    got = op.type_metrics(df, "approx").first().median_amount_k * 1000
    assert abs(got - 1_000_000) < 0.005 * 2_000_000


def test_exact_median_reads_its_input_twice(spark, frame, tmp_path):
    """Counted in the plan that ran, where every reused shuffle is one scan less."""
    path = str(tmp_path / "layer")
    rows = [(t, float(i), 2.0, 1.0) for i in range(200) for t in ("DEBIT", "PAYMENT")]
    frame(*rows).write.parquet(path)
    for options, most in (({"domain": TRANSACTION_TYPES}, 2), ({"median": "approx", "domain": TRANSACTION_TYPES}, 1)):
        result = op.type_metrics(spark.read.parquet(path), **options)
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("FileScan") == most


def test_scans_read_only_the_columns_they_need(spark, frame, tmp_path):
    path = str(tmp_path / "layer")
    frame(("DEBIT", 1.0, 2.0, 1.0)).selectExpr("*", "1 as isFraud", "'x' as nameOrig").write.parquet(path)
    df = spark.read.parquet(path)

    def scans(**options):
        plan = op.type_metrics(df, **options)._jdf.queryExecution().sparkPlan().toString()
        return sorted(line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line)

    wide = "struct<type:string,amount:double,oldbalanceOrg:double,newbalanceOrig:double>"
    assert scans(median="approx", domain=TRANSACTION_TYPES) == [wide]
    # The total of an open domain is counted without reading any column.
    assert scans(median="approx") == [wide]
    assert "ReadSchema: struct<>" in op.type_metrics(df, "approx")._jdf.queryExecution().executedPlan().toString()
    exact = scans(domain=TRANSACTION_TYPES)
    # How many of these scans run is counted in the test above: shuffles are reused.
    assert set(exact) == {wide, "struct<type:string,amount:double>"}
