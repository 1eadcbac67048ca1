import pytest

from ledgerlake import operators as op


def test_valid_table_passes_unchanged(frame):
    df = frame(("CASH_IN", 12.5, 3.0, 15.5), ("DEBIT", 7.0, 31.0, 24.0))
    assert op.assert_domain(df) is df


def test_error_lists_types_and_counts(frame):
    df = frame(
        ("VOUCHER", 8.0, 9.0, 1.0),
        ("VOUCHER", 1.0, 2.0, 1.0),
        ("cash_out", 1.0, 2.0, 1.0),
        ("CASH-IN", 1.0, 2.0, 1.0),
        ("DEBIT", -3.0, 17.0, 20.0),
    )
    with pytest.raises(ValueError, match="(?i)invalid transaction types") as caught:
        op.assert_domain(df)
    listed = {r["type"]: r["count"] for r in caught.value.report.collect()}
    assert listed == {"VOUCHER": 2, "CASH-IN": 1, "cash_out": 1}
    assert (caught.value.rows, caught.value.types) == (4, 3)
    assert "3 types in 4 rows" in str(caught.value)


@pytest.mark.parametrize("types", [25, 300])
def test_error_reports_every_type(spark, types):
    df = spark.range(10 * types).selectExpr(f"concat('X', id % {types}) as type")
    with pytest.raises(op.InvalidTypeError) as caught:
        op.assert_domain(df)
    assert (caught.value.rows, caught.value.types) == (10 * types, types)
    listed = {r["type"]: r["count"] for r in caught.value.report.collect()}
    assert listed == {f"X{i}": 10 for i in range(types)}


def test_null_type_is_not_invalid(frame):
    df = frame((None, 1.0, 2.0, 1.0), ("PAYMENT", 1.0, 2.0, 1.0))
    op.assert_domain(df)
    assert op.invalid_type_report(df).isEmpty()


def test_split_keeps_every_row_once(frame):
    df = frame(
        (None, 1.0, 2.0, 1.0),
        ("PAYMENT", 1.0, 2.0, 1.0),
        ("PAYMENT", 1.0, 2.0, 1.0),
        ("REFUND", 1.0, 2.0, 1.0),
    )
    good, quarantine = op.split_valid(df)
    assert sorted(str(r.type) for r in good.collect()) == ["None", "PAYMENT", "PAYMENT"]
    assert [r.type for r in quarantine.collect()] == ["REFUND"]
    assert good.unionAll(quarantine).exceptAll(df).isEmpty()
    counts = op.quarantine_counts(df).first()
    assert counts.asDict() == {"total_rows": 4, "passing_rows": 3, "quarantined_rows": 1}


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="amount, oldbalanceOrg, newbalanceOrig"):
        op.assert_columns(spark.createDataFrame([("PAYMENT",)], "type string"))


def test_gate_reads_the_type_column_only(spark, frame, tmp_path):
    path = str(tmp_path / "layer")
    frame(("PAYMENT", 1.0, 2.0, 1.0)).write.parquet(path)
    report = op.invalid_type_report(spark.read.parquet(path))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<type:string>" in plan
    assert "PushedFilters: [Not(In(type" in plan
