import pytest

from ledgerlake import sources
from ledgerlake.contracts import TRANSACTION_SCHEMA

HEADER = (
    "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,"
    "oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud"
)
GOOD = "4,PAYMENT,310.5,C77,1200.0,889.5,M31,0.0,0.0,0,0"


@pytest.fixture
def csv(tmp_path):
    def write(*lines, header=HEADER, name="in.csv"):
        path = tmp_path / name
        path.write_text("\n".join([header, *lines]) + "\n")
        return str(path)

    return write


def test_schema_and_values(spark, csv):
    df = sources.read_transactions_csv(spark, csv(GOOD))
    assert df.schema == TRANSACTION_SCHEMA
    row = (4, "PAYMENT", 310.5, "C77", 1200.0, 889.5, "M31", 0.0, 0.0, 0, 0)
    assert [tuple(r) for r in df.collect()] == [row]


def test_malformed_lines_are_kept_leniently(spark, csv):
    path = csv(
        GOOD,
        GOOD.replace("310.5", "abc"),  # bad cell
        "2,DEBIT,5.0",  # short
        GOOD + ",extra,extra",  # long
        "",  # blank
        "3,,,C1,,,M1,,,0,0",  # empty cells
    )
    rows = sources.read_transactions_csv(spark, path).collect()
    assert [r.amount for r in rows] == [310.5, None, 5.0, 310.5, None]
    assert [r.type for r in rows] == ["PAYMENT", "PAYMENT", "DEBIT", "PAYMENT", None]
    assert rows[2].isFraud is None and rows[3].isFlaggedFraud == 0


def test_malformed_lines_can_be_captured(spark, csv):
    bad = GOOD.replace("310.5", "abc")
    df = sources.read_transactions_csv(spark, csv(GOOD, bad, "2,DEBIT,5.0"), corrupt_column="raw_line")
    assert df.columns == [*TRANSACTION_SCHEMA.names, "raw_line"]
    assert [r.raw_line for r in df.collect()] == [None, bad, "2,DEBIT,5.0"]


def test_header_binds_by_position_unless_strict(spark, csv):
    swapped = HEADER.replace("step,type", "type,step")
    path = csv("PAYMENT,4," + GOOD.split(",", 2)[2], header=swapped)
    assert sources.read_transactions_csv(spark, path).first().step is None
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_transactions_csv(spark, path, strict_header=True).collect()
    assert sources.read_transactions_csv(spark, csv(GOOD), strict_header=True).count() == 1


def test_unreadable_files_fail_unless_skipped(spark, tmp_path):
    path = str(tmp_path / "layer")
    spark.range(3).write.parquet(path)
    (tmp_path / "layer" / "broken.parquet").write_bytes(b"not a parquet file")
    schema = spark.range(0).schema
    with pytest.raises(Exception, match="broken.parquet"):
        sources.read_layer(spark, path, schema).collect()
    rows = sources.read_layer(spark, path, schema, skip_unreadable=True).collect()
    assert sorted(r.id for r in rows) == [0, 1, 2]


def test_layer_path():
    assert sources.layer_path("s3://lake/", "gold", "r1") == "s3://lake/gold/run_id=r1"
    ids = {sources.new_run_id() for _ in range(1000)}
    assert len(ids) == 1000


def test_write_counts_rows_and_checks(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "out")
    df = spark.range(100).repartition(5)
    for _ in range(2):  # a second write replaces the first
        seen = sources.write_layer(df, path, {"even": F.count_if(F.col("id") % 2 == 0)})
        assert seen == {"rows": 100, "even": 50}
    assert sources.read_layer(spark, path).count() == 100


def test_write_of_no_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "out")
    df = spark.createDataFrame([], "type string")
    assert sources.write_layer(df, path, {"n": F.count_if(F.col("type") == "x")}) == {"rows": 0, "n": 0}
    assert sources.read_layer(spark, path).columns == ["type"]
    grouped = spark.range(10).where("id < 0").groupBy("id").count()
    assert sources.write_layer(grouped, path) == {"rows": 0}


def test_failed_write_leaves_the_old_rows(spark, tmp_path):
    """A task that fails after other tasks have written, and a writer that is killed before its commit."""
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    sources.write_layer(spark.range(10), path)
    bad = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        sources.write_layer(bad, path)
    assert sources.read_layer(spark, path).count() == 10
    assert len(list(tmp_path.glob("t/_attempt-*"))) == 1
    killed = sources.stage_layer(spark.range(77), path)  # whole, but never published
    assert sources.read_layer(spark, path).count() == 10
    assert sources.remove_unpublished(spark, path) == 1
    assert not list(tmp_path.glob(f"t/{killed.folder.rsplit('/', 1)[1]}"))
    # A table may be replaced by rows read from it.
    sources.write_layer(sources.read_layer(spark, path).where("id < 4"), path)
    assert sorted(r.id for r in sources.read_layer(spark, path).collect()) == [0, 1, 2, 3]


def test_catalogue(spark, tmp_path):
    base = str(tmp_path / "lake")
    assert sources.published_runs(spark, base).count() == 0
    with pytest.raises(FileNotFoundError):
        sources.read_run(spark, base, "silver")
    for run_id, n in (("a", 1), ("b", 2), ("a", 3)):
        tables = [
            sources.stage_layer(spark.range(k), sources.layer_path(base, layer, run_id), layer=layer)
            for layer, k in (("silver", n), ("gold", 10 * n))
        ]
        if run_id == "b":
            found = sources.read_run(spark, base, "gold").count()  # before the commit
            assert found == 10
        sources.commit(spark, sources.log_path(tables[0].target), tables, run_id)
    rows = {(r["run_id"], r["layer"]): (r["rows"], r["newest"]) for r in sources.published_runs(spark, base).collect()}
    assert rows == {
        ("a", "silver"): (3, True), ("a", "gold"): (30, True), ("b", "silver"): (2, False), ("b", "gold"): (20, False)
    }
    assert sources.read_run(spark, base, "silver").count() == 3
    assert sources.read_run(spark, base, "silver", "b").count() == 2
    assert sources.read_layer(spark, sources.layer_path(base, "gold", "a")).count() == 30
    with pytest.raises(FileNotFoundError):
        sources.read_run(spark, base, "silver", "c")
    with pytest.raises(FileNotFoundError):
        sources.read_layer(spark, sources.layer_path(base, "silver", "c"))
    with pytest.raises(Exception, match="(?i)schema"):  # nothing is found past the catalogue
        spark.read.parquet(f"{base}/silver").count()


def test_columns_bind_by_each_files_header(spark, tmp_path, csv):
    import gzip

    folder = tmp_path / "in"
    folder.mkdir()
    names, cells = HEADER.split(","), GOOD.split(",")
    (folder / "a.csv").write_text(f"{HEADER}\n{GOOD}\n")
    turned = f"{','.join(names[::-1])},branch\n{','.join(cells[::-1])},x\n"
    with gzip.open(folder / "b.csv.gz", "wt") as file:
        file.write(turned)
    fewer = "﻿" + ",".join(names[:3]) + ',"Type"\n5,DEBIT,n/a,1\n6,DEBIT\n'
    (folder / "c.csv").write_text(fewer, encoding="utf-8")
    (folder / "d.csv").write_text("")
    df = sources.read_transactions_csv(spark, str(folder), by_name=True, corrupt_column="raw")
    assert df.columns == [*TRANSACTION_SCHEMA.names, "raw"]
    assert [f.dataType for f in df.schema.fields][:-1] == [f.dataType for f in TRANSACTION_SCHEMA.fields]
    rows = sorted((tuple(r) for r in df.collect()), key=repr)
    whole = (4, "PAYMENT", 310.5, "C77", 1200.0, 889.5, "M31", 0.0, 0.0, 0, 0, None)
    short = [(5, "DEBIT", None, *[None] * 8, "5,DEBIT,n/a,1"), (6, "DEBIT", None, *[None] * 8, "6,DEBIT")]
    assert rows == sorted([whole, whole, *short], key=repr)
    twice = csv(GOOD, header=HEADER.replace("isFraud,", "step,"), name="twice.csv")
    with pytest.raises(ValueError, match="step more than once"):
        sources.read_transactions_csv(spark, twice, by_name=True)
    assert sources.read_transactions_csv(spark, str(folder / "d.csv"), by_name=True).count() == 0
    with pytest.raises(ValueError, match="not both"):
        sources.read_transactions_csv(spark, twice, by_name=True, strict_header=True)
