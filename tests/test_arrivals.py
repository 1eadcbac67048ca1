import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from ledgerlake import operators as op
from ledgerlake import plans
from ledgerlake.sources import published_runs, read_run
from tests.test_sources import GOOD, HEADER


@pytest.fixture
def arrive(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, *lines):
        (folder / f"{name}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        return str(folder)

    return write


def amounts(spark, base):
    runs = {r["run_id"] for r in published_runs(spark, base).collect()}
    return sorted(r["amount"] for run_id in runs for r in read_run(spark, base, "silver", run_id).collect())


def test_every_file_is_taken_once(spark, arrive, tmp_path):
    base, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    lines = [GOOD.replace("310.5", f"{i}.0") for i in range(1, 7)]
    source = arrive("a", *lines[:2])
    arrive("b", *lines[2:4])
    first = plans.run_arrivals(spark, source, base, checkpoint, files_per_batch=1)
    assert len(first) == 2 and amounts(spark, base) == [1, 2, 3, 4]
    assert plans.run_arrivals(spark, source, base, checkpoint) == []
    arrive("c", *lines[1:5], lines[4])  # three rows have arrived before, one comes twice
    assert len(plans.run_arrivals(spark, source, base, checkpoint)) == 1
    assert amounts(spark, base) == [1, 2, 3, 4, 5]
    gold = plans.metrics_over_runs(spark, base).first()
    assert (gold["transaction_count"], gold["total_volume_m"]) == (5, round(15 / 1e6, 3))


def test_a_batch_that_fails_is_taken_again(spark, arrive, tmp_path):
    base, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    source = arrive("a", GOOD, GOOD.replace("310.5", "-1.0"))
    with pytest.raises(Exception, match="expectations failed"):
        plans.run_arrivals(spark, source, base, checkpoint, clean_gate=op.TRANSACTION_EXPECTATIONS)
    assert published_runs(spark, base).count() == 0
    (run_id,) = plans.run_arrivals(
        spark, source, base, checkpoint, quarantine=True, route=op.TRANSACTION_EXPECTATIONS
    )
    assert amounts(spark, base) == [310.5]
    assert read_run(spark, base, "quarantine", run_id).count() == 1


def test_the_query_derives_its_rows_once(spark, monkeypatch):
    """Three deliveries are parts of one stored table; each row is derived once for all."""
    derived = spark.sparkContext.accumulator(0)

    def noted(step):
        derived.add(1)
        return step

    def rows(spark, sf_dir):
        step = F.udf(noted, "int")(F.lit(1).cast("int") + F.col("id").cast("int"))
        kept = {"step": step, "type": F.lit("PAYMENT"), "amount": F.col("id").cast("double")}
        for field in entry_point.TRANSACTION_SCHEMA:
            kept.setdefault(field.name, F.lit("1").cast(field.dataType))
        return spark.range(1, 41).select(
            F.col("id").alias("txn_id"), *(kept[n].alias(n) for n in entry_point.TRANSACTION_SCHEMA.fieldNames())
        )

    monkeypatch.setattr(entry_point, "transactions", rows)
    (metrics,) = [r for r in entry_point.metrics_of_arrivals(spark, "").collect() if r["transaction_count"]]
    assert (metrics["type"], metrics["transaction_count"], metrics["median_within_bound"]) == ("PAYMENT", 40, True)
    assert derived.value == 40
