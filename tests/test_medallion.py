import json
import os
import re
import subprocess
import sys
from pathlib import Path

import pytest

from ledgerlake import operators as op
from ledgerlake import plans
from ledgerlake.contracts import METRIC_COLUMNS, TRANSACTION_SCHEMA, FeeRule, Ledger
from ledgerlake.sources import published_runs, read_layer, read_run, scratch_path
from testtables import write_transactions_csv
from tests.test_sources import GOOD, HEADER

REPO = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"


@pytest.fixture
def source(tmp_path):
    def write(*lines):
        path = tmp_path / "in.csv"
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return write


def nothing_left(base, layer):
    """No data of a layer, published or not."""
    return not list((base / layer).rglob("*.parquet"))


def test_one_row_through_all_layers(spark, source, tmp_path):
    run = plans.run_medallion(spark, source(GOOD), str(tmp_path / "lake"), run_id="r1")
    assert [layer.rows for layer in (run.bronze, run.silver, run.gold)] == [1, 1, 1]
    summary = run.summary()
    assert set(summary) == {"bronze_path", "silver_path", "gold_path", "start_time", "duration"}
    for layer in ("bronze", "silver", "gold"):
        stored = spark.read.parquet(summary[f"{layer}_path"])
        assert stored.count() == 1 and "type" in stored.columns
    assert spark.read.parquet(run.silver.path).schema.names == TRANSACTION_SCHEMA.names
    gold = spark.read.parquet(run.gold.path)
    assert tuple(gold.columns) == METRIC_COLUMNS
    assert op.passes(gold, op.METRIC_EXPECTATIONS)


def test_repeating_a_run_replaces_it_and_others_stay(spark, source, tmp_path):
    base = str(tmp_path / "lake")
    path = source(GOOD)
    first = plans.run_medallion(spark, path, base, run_id="a")
    plans.run_medallion(spark, path, base, run_id="b")
    again = plans.run_medallion(spark, path, base, run_id="a")
    assert again.gold.target == first.gold.target and again.gold.path != first.gold.path
    assert published_runs(spark, base).groupBy("run_id").count().count() == 2
    assert read_layer(spark, first.silver.target).count() == 1
    assert read_run(spark, base, "silver", "a").count() == 1


def test_invalid_type_stops_the_run_before_silver(spark, source, tmp_path):
    path = source(GOOD, GOOD.replace("PAYMENT", "CASH-IN"))
    with pytest.raises(op.InvalidTypeError) as caught:
        plans.run_medallion(spark, path, str(tmp_path / "lake"), run_id="r")
    assert (caught.value.rows, caught.value.types) == (1, 1)
    stored = read_layer(spark, str(tmp_path / "lake" / "rejected" / "run_id=r"))
    assert [tuple(r) for r in stored.collect()] == [("CASH-IN", 1)]
    assert caught.value.report.collect() == stored.collect()
    assert published_runs(spark, str(tmp_path / "lake")).count() == 0
    assert nothing_left(tmp_path / "lake", "bronze")
    assert not (tmp_path / "lake" / "silver").exists()


def test_suite_can_gate_the_clean_layer(spark, source, tmp_path):
    path = source(GOOD, GOOD.replace("310.5", "-1.0"))
    run = plans.run_medallion(spark, path, str(tmp_path / "lenient"))
    with pytest.raises(ValueError, match=r"amount between \(1 cells\)"):
        plans.run_medallion(spark, path, str(tmp_path / "strict"), suite=op.TRANSACTION_EXPECTATIONS)
    assert not (tmp_path / "strict" / "silver").exists()
    target = str(tmp_path / "silver")
    with pytest.raises(ValueError, match="amount between"):
        plans.clean_layer(spark, run.bronze.path, target, op.TRANSACTION_EXPECTATIONS)
    plans.clean_layer(spark, run.bronze.path, target, [op.not_null("amount")])
    good = plans.run_medallion(spark, source(GOOD), str(tmp_path / "ok"), suite=op.TRANSACTION_EXPECTATIONS)
    assert good.silver.rows == 1


def test_header_only_input(spark, source, tmp_path):
    run = plans.run_medallion(spark, source(), str(tmp_path / "lake"))
    assert [layer.rows for layer in (run.bronze, run.silver, run.gold)] == [0, 0, 0]
    assert tuple(spark.read.parquet(run.gold.path).columns) == METRIC_COLUMNS


def test_invariants_on_the_derived_tables(spark, tmp_path):
    path = write_transactions_csv(spark, SF)
    run = plans.run_medallion(spark, path, str(tmp_path / "lake"))
    gold = spark.read.parquet(run.gold.path).collect()
    assert sum(r.transaction_count for r in gold) == run.silver.rows == 1515
    assert abs(sum(r.percentage_of_total for r in gold) - 100) < 0.1
    assert run.silver.checks == {
        "invalid_types": 0,
        "payment_fee_exceeded": 213,
        "transfer_fee_exceeded": 122,
        "cashout_fee_exceeded": 80,
    }
    # Alone, each layer takes the same checks from its input.
    silver = plans.clean_layer(spark, run.bronze.path, str(tmp_path / "silver"))
    assert (silver.rows, silver.checks) == (run.silver.rows, run.silver.checks)
    for median in ("exact", "approx"):
        alone = plans.metrics_layer(spark, silver.path, str(tmp_path / median), median)
        assert alone.rows == 5
    again = plans.clean_layer(spark, silver.path, str(tmp_path / "again"))
    assert again.rows == 1500  # null and 0 copies are equal once filled


def test_an_older_verdict_does_not_pass_another_suite(spark, source, tmp_path):
    path = source(GOOD.replace("310.5", "5.0"))
    lenient, strict = [op.between("amount", min_value=0)], [op.between("amount", min_value=100)]
    bronze = plans.ingest_layer(spark, path, str(tmp_path / "bronze"), lenient)
    target = str(tmp_path / "silver")
    for suite in (strict, [op.not_null("amount")], []):
        with pytest.raises(ValueError, match="another suite"):
            plans.clean_layer(spark, bronze.path, target, suite, checked=bronze)
    with pytest.raises(ValueError, match="another path"):
        plans.clean_layer(spark, path, target, lenient, checked=bronze)
    with pytest.raises(ValueError, match="another ledger"):
        plans.clean_layer(spark, bronze.path, target, lenient, bronze, Ledger(types=("PAYMENT",)))
    with pytest.raises(plans.ChecksFailed) as caught:
        plans.clean_layer(spark, bronze.path, target, strict)
    assert list(caught.value.unexpected.values()) == [1]
    assert not (tmp_path / "silver").exists()
    silver = plans.clean_layer(spark, bronze.path, target, lenient, checked=bronze)
    assert silver.rows == 1
    with pytest.raises(ValueError, match="another path"):
        plans.metrics_layer(spark, bronze.path, str(tmp_path / "gold"), cleaned=silver)


def test_quarantine_keeps_every_row(spark, source, tmp_path):
    lines = [GOOD, GOOD.replace("PAYMENT", "VOUCHER"), GOOD.replace("310.5", "n/a"), "4,DEBIT,1.0"]
    run = plans.run_medallion(spark, source(*lines), str(tmp_path / "lake"), "r", quarantine=True)
    aside = run.silver.quarantined
    assert (run.bronze.rows, run.silver.rows, aside.rows) == (4, 1, 3)
    assert run.silver.checks["malformed_lines"] == 2 and run.silver.checks["invalid_types"] == 1
    rows = spark.read.parquet(aside.path).collect()
    assert sorted(str(r[plans.MALFORMED]) for r in rows) == sorted([lines[2], lines[3], "None"])
    assert plans.MALFORMED not in spark.read.parquet(run.silver.path).columns
    good = plans.run_medallion(spark, source(GOOD), str(tmp_path / "good"), quarantine=True)
    assert good.silver.quarantined is None and good.gold.rows == 1


def test_gates_after_silver_and_gold(spark, source, tmp_path):
    good, off = source(GOOD), GOOD.replace("889.5", "800.0")
    gates = {"balance_type": "PAYMENT", "metric_gate": op.METRIC_EXPECTATIONS, "clean_gate": [op.not_null("amount")]}
    run = plans.run_medallion(spark, good, str(tmp_path / "a"), **gates)
    assert run.silver.checks["balance_unexpected"] == 0
    with pytest.raises(plans.ChecksFailed, match="balance_unexpected") as caught:
        plans.run_medallion(spark, source(off), str(tmp_path / "b"), **gates)
    assert caught.value.layer == "silver" and not (tmp_path / "b" / "gold").exists()
    assert all(nothing_left(tmp_path / "b", layer) for layer in ("bronze", "silver"))
    zero = source(GOOD.replace("310.5", "0.0").replace("889.5", "1200.0"))
    with pytest.raises(plans.ChecksFailed, match="avg_amount_k") as caught:
        plans.run_medallion(spark, zero, str(tmp_path / "c"), **gates)
    assert caught.value.layer == "gold"
    assert all(nothing_left(tmp_path / "c", layer) for layer in ("bronze", "silver", "gold"))


def test_another_ledger(spark, source, tmp_path):
    ledger = Ledger(
        types=("GIFT", "LOAN"),
        fee_rules=(FeeRule("LOAN", 0.5, "loan_too_dear"),),
        large_amount=100,
    )
    lines = [
        GOOD.replace("PAYMENT", "GIFT"),
        GOOD.replace("PAYMENT", "LOAN").replace("889.5", "100.0"),
        GOOD.replace("PAYMENT", "LOAN").replace("310.5", "10.0").replace("889.5", "1190.0"),
    ]
    for median in ("exact", "approx"):
        run = plans.run_medallion(spark, source(*lines), str(tmp_path / median), median=median, ledger=ledger)
        assert run.silver.checks == {"invalid_types": 0, "loan_too_dear": 1}
        gold = {r.type: r for r in spark.read.parquet(run.gold.path).collect()}
        assert gold["LOAN"].large_txn_ratio_pct == 50.0 and gold["GIFT"].large_txn_ratio_pct == 100.0
    with pytest.raises(op.InvalidTypeError):
        plans.run_medallion(spark, source(GOOD), str(tmp_path / "other"), ledger=ledger)


def test_missing_files_can_be_skipped(spark, source, tmp_path):
    path = source(GOOD)
    broken = tmp_path / "broken.csv.gz"
    broken.write_bytes(b"no gzip")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark raises
        plans.ingest_layer(spark, [path, str(broken)], str(tmp_path / "a"))
    run = plans.ingest_layer(spark, [path, str(broken)], str(tmp_path / "b"), skip_unreadable=True)
    assert run.rows == 1


def test_shuffle_size_grows_with_rows_in_a_session_of_its_own(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    assert plans.shuffle_partitions(0) == 1
    assert plans.shuffle_partitions(8_000_001) == 2
    assert plans.shuffle_partitions(100, rows_per_partition=10) == 10
    assert plans.sized_session(spark, 10) is spark
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    large = plans.sized_session(spark, 10**12)
    assert large.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert large.conf.get(name) == "125000" and spark.conf.get(name) == before


def test_shuffle_size_reaches_the_plan(spark):
    session = plans.sized_session(spark, 20 * 8_000_000)
    df = session.createDataFrame([(1,)], "n int").distinct()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(n#\d+, 20\)", plan)


def test_a_layer_is_cleaned_with_a_sized_session(spark, source, tmp_path):
    lines = [GOOD.replace("4,", f"{i},", 1) for i in range(60)]
    run = plans.run_medallion(spark, source(*lines), str(tmp_path / "lake"), rows_per_partition=2)
    assert (run.silver.rows, run.gold.rows) == (60, 1)


def run_script(body, **conf):
    """Run ``body`` on a fresh session with ``conf``; return what it prints."""
    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", **conf}
    script = f"""
from pyspark.sql import SparkSession
builder = SparkSession.builder.master("local[2, 3]")  # a task may fail twice
for name, value in {conf!r}.items():
    builder = builder.config(name, value)
spark = builder.getOrCreate()
{body}
spark.stop()
"""
    command = [sys.executable, "-c", script]
    done = subprocess.run(command, cwd=REPO, check=True, capture_output=True, timeout=300, text=True)
    return done.stdout


def test_scratch_is_in_the_shared_folder_the_session_names(tmp_path):
    body = "from ledgerlake.sources import scratch_path; print(scratch_path(spark, 'x'))"
    printed = run_script(body, **{"spark.checkpoint.dir": f"{tmp_path}/"})
    assert printed.startswith(f"{tmp_path}/ledgerlake-x-") and printed.strip().endswith("/x")


def test_nothing_is_left_in_the_shared_folder(tmp_path):
    body = f"""
import __spark_entry__ as entry_point
for name in ("type_metrics", "csv_ingest_profile", "medallion_end_to_end"):
    entry_point.queries()[name](spark, {SF!r}).collect()
import os
print(len(os.listdir({str(tmp_path)!r})))
"""
    printed = run_script(body, **{"spark.checkpoint.dir": str(tmp_path)})
    assert int(printed) >= 4
    assert not list(tmp_path.glob("ledgerlake-*"))


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(spark)


def test_counts_are_exact_when_tasks_fail_and_run_again(tmp_path):
    body = f"""
from pyspark import TaskContext
from pyspark.sql import functions as F
from ledgerlake.sources import read_layer, write_layer

def flaky(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost after all rows were passed on")

df = spark.range(0, 1000, 1, 4).mapInPandas(flaky, "id bigint")
seen = write_layer(df, {str(tmp_path / "out")!r}, {{"even": F.count_if(F.col("id") % 2 == 0)}})
print(seen["rows"], seen["even"], read_layer(spark, {str(tmp_path / "out")!r}).count())
"""
    assert run_script(body).split() == ["1000", "500", "1000"]


def test_command_line(tmp_path, source):
    command = [sys.executable, "-m", "ledgerlake", source(GOOD), str(tmp_path / "lake")]
    command += ["--run-id", "r1", "--expect", "--strict-header", "--median", "approx"]
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--conf spark.ui.enabled=false pyspark-shell"}
    done = subprocess.run(
        command, cwd=REPO, check=True, capture_output=True, timeout=300, text=True, env=env
    )
    assert "SparkUI" not in done.stderr
    summary = json.loads(done.stdout)
    assert summary["gold_path"].startswith(f"{tmp_path}/lake/gold/run_id=r1/")
    assert list(Path(summary["gold_path"]).glob("*.parquet"))


def test_a_run_is_three_actions_and_a_commit(tmp_path, source):
    """Counted in Spark's event log: one SQL execution per layer, checks included."""
    logs = tmp_path / "events"
    logs.mkdir()
    path = source(GOOD, GOOD)
    run_script(
        f"""
from ledgerlake.plans import run_medallion
from ledgerlake.operators import TRANSACTION_EXPECTATIONS
run_medallion(spark, {path!r}, {str(tmp_path / "lake")!r}, suite=TRANSACTION_EXPECTATIONS)
""",
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{logs}",
            "spark.eventLog.compress": "false",
        },
    )
    events = [
        json.loads(line)
        for path in logs.rglob("*")
        if path.is_file() and ("events_" in path.name or path.name.startswith("local-"))
        for line in open(path)
    ]
    executions = {e["executionId"] for e in events if e["Event"].endswith("SQLExecutionStart")}
    assert len(executions) == 3 + 1
