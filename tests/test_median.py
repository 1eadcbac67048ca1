"""The exact median against brute force, on ordinary and hostile data."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from ledgerlake import operators as op
from ledgerlake.functions import bin_span, linear_bin, log_bin

DOMAIN = tuple("abcdefghijkl")
INF, NAN = float("inf"), float("nan")


def order(value):
    return (math.isnan(value), 0.0 if math.isnan(value) else value)


def brute_force(rows):
    groups = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    return {k: sorted(v, key=order)[(len(v) - 1) // 2] for k, v in groups.items()}


def medians(spark, rows, domain):
    df = spark.createDataFrame(rows, "k string, v double")
    return {r.k: r["median"] for r in op.median_by_key(df, "k", "v", domain).collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for key in got:
        assert order(got[key]) == order(want[key])


SPECIAL = [None, 0.0, -0.0, 1.0, 5e-324, -5e-324, 1.7976931348623157e308, INF, -INF, NAN]


def random_table(rng, number):
    """Up to 60 cells: special ones, a narrow range, or all magnitudes."""
    kind = rng.randrange(4)
    for _ in range(rng.randrange(1, 60)):
        if kind == 0 or rng.random() < 0.2:
            cell = rng.choice(SPECIAL)
        elif kind == 1:
            cell = rng.uniform(99.9, 100.1)
        else:
            cell = rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)
        yield f"t{number}", cell


@pytest.mark.parametrize("closed", [True, False], ids=["closed", "open"])
def test_against_brute_force(spark, closed):
    """Many tables in one job: the table is the key."""
    rng = random.Random(12)
    rows = [row for number in range(1500) for row in random_table(rng, number)]
    rows += [(None, v) for _, v in rows[:50]]
    domain = [f"t{number}" for number in range(1500)] if closed else None
    same(medians(spark, rows, domain), brute_force(rows))


def test_a_large_domain_is_refused(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    with pytest.raises(ValueError, match="at most 10000 keys"):
        op.median_by_key(df, "k", "v", [str(i) for i in range(10_001)])


def test_one_bin_of_one_key_is_spread_on_the_open_path(spark):
    """Adaptive execution and broadcasts off: the parts must come from the plan."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        df = spark.range(40_000).select(F.lit("a").alias("k"), (1.7e9 + F.col("id") / 1000).alias("v"))
        result = op.median_by_key(df, "k", "v")
        assert result.first()["median"] == 1.7e9 + 19.999
        # The join's keys hold the part that a value's hash chooses.
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "pmod(xxhash64(value" in plan
        parts = df.select(F.pmod(F.xxhash64("v"), F.lit(16)).alias("p")).groupBy("p").count().collect()
        assert len(parts) == 16 and max(r["count"] for r in parts) < 40_000 / 8
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("domain", [DOMAIN, None], ids=["closed", "open"])
def test_hot_key_hot_value_and_heavy_tail(spark, domain):
    # "a" holds most rows, a third of all rows are one value, the tail is long.
    df = spark.range(30000).select(
        F.when(F.col("id") % 10 < 8, "a").when(F.col("id") % 10 == 8, "b").alias("k"),
        F.when(F.col("id") % 3 == 0, 777.25)
        .otherwise(F.exp((F.xxhash64("id") % 1000) / 25.0))
        .alias("v"),
    )
    want = brute_force([(r.k, r.v) for r in df.collect()])
    got = {r.k: r["median"] for r in op.median_by_key(df, "k", "v", domain).collect()}
    assert got == want


def test_values_within_one_fine_bin(spark):
    # Neighbouring doubles share every bin; only the last ranking tells them apart.
    base = struct.unpack("<q", struct.pack("<d", 123456.78))[0]
    values = [struct.unpack("<d", struct.pack("<q", base + i))[0] for i in range(101)]
    rows = [("a", v) for v in values]
    for domain in (DOMAIN, None):
        assert medians(spark, rows, domain) == {"a": values[50]}


@pytest.mark.parametrize("domain", [DOMAIN, None], ids=["closed", "open"])
def test_dense_values_in_a_narrow_range(spark, domain):
    # All values share a coarse bin; the fine bins adapt to the range they span.
    df = spark.range(20001).select(F.lit("a").alias("k"), (1.7e9 + F.col("id") / 1000).alias("v"))
    assert op.median_by_key(df, "k", "v", domain).first()["median"] == 1.7e9 + 10.0


def test_bins_never_decrease(spark):
    values = sorted(
        [-INF, -1e308, -2.5, -1e-300, -5e-324, 0.0, 5e-324, 1e-300, 0.1, 1.0, 2.5, 1e308, INF]
        + [math.exp(i / 7) for i in range(-50, 50)]
    ) + [NAN]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    bins = [r.b for r in df.select("i", log_bin(F.col("v"), 256).alias("b")).orderBy("i").collect()]
    assert bins == sorted(bins)
    assert len(set(bins[-2:])) == 2  # NaN sorts above infinity
    assert bins[-1] - bins[0] < bin_span(256)

    bounded = df.where("v > 0 and v < 1e300")
    fine = linear_bin(F.col("v"), F.lit(5e-324), F.lit(1e300), 1000)
    bins = [r.b for r in bounded.select("i", fine.alias("b")).orderBy("i").collect()]
    assert bins == sorted(bins) and 0 <= bins[0] and bins[-1] <= 1000
    assert bounded.select(linear_bin(F.col("v"), F.col("v"), F.col("v"), 9)).distinct().first()[0] == 0


def test_broadcasts_only_with_a_closed_domain(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1.0)], "k string, v double").write.parquet(path)
    df = spark.read.parquet(path)

    def hints(domain):
        return op.median_by_key(df, "k", "v", domain)._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")

    assert hints(DOMAIN) > 0
    assert hints(None) == 0
