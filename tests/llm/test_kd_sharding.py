import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.kd_sharding import kd_leaves, shard_documents

from .data import SCHEMA, empty, odd, odd_rows, prose


def documents(spark, n=900, hot=0):
    rng = np.random.default_rng(n)
    rows = []
    for i in range(n):
        text = prose(int(rng.integers(1, 60)), i) if i >= hot else "the same text " * 9
        rows.append((i, text, "en", "hot" if i % 3 else f"s{i % 9}", len(text)))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def checked(rows, shards):
    for s in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    weights = Counter()
    of_text = {}
    for r in rows:
        weights[r["shard"]] += r["size"]
        assert of_text.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
    return weights


@pytest.mark.parametrize("shards", [1, 2, 3, 8, 11])
def test_even_bytes(spark, shards):
    docs = documents(spark)
    rows = shard_documents(docs, shards=shards).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    weights = checked(rows, shards)
    mean = sum(weights.values()) / shards
    largest = max(r["size"] for r in rows)
    assert all(abs(w - mean) <= 2 * largest for w in weights.values()) and len(weights) == shards
    again = {r["doc_id"]: r["shard"] for r in shard_documents(docs.repartition(3), shards=shards).collect()}
    assert again == {r["doc_id"]: r["shard"] for r in rows}


def test_hot_group_stays_together(spark):
    docs = documents(spark, 600, hot=300)
    rows = shard_documents(docs, shards=8).collect()
    weights = checked(rows, 8)
    hot = next(r["shard"] for r in rows if r["doc_id"] == 0)
    rest = [w for s, w in weights.items() if s != hot]
    assert len(rows) == 600 and max(rest) < 2 * np.mean(rest)


def test_target_bytes(spark):
    docs = documents(spark, 300)
    total = sum(r["size"] for r in shard_documents(docs, shards=1).collect())
    rows = shard_documents(docs, target_bytes=total // 6).collect()
    assert len({r["shard"] for r in rows}) == 7
    assert max(checked(rows, 7).values()) < 1.3 * total / 6


def test_cuts_the_widest_dimension(spark):
    points = spark.createDataFrame([(i, 1, float(i), float(i % 7 == 0) * 1e9) for i in range(64)], "id bigint, w bigint, a double, b double")
    halves = kd_leaves(points, "w", ["a"], 2, ["id"]).collect()
    assert {r["id"] for r in halves if r["shard"] == 0} == set(range(32))


def test_odd_rows(spark):
    for table in (odd(spark, shard="x", size=1, weight=2), odd(spark).drop("lang", "source", "n_chars")):
        rows = shard_documents(table, shards=3).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows())
        checked(rows, 3)
        sizes = Counter((r["doc_id"], r["size"]) for r in rows)
        assert sizes == Counter((k, len((t or "").encode()) + 1) for k, t, *_ in odd_rows())


def test_empty(spark):
    assert shard_documents(empty(spark), shards=8).count() == 0
    assert shard_documents(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = shard_documents(documents(spark, 50).withColumn("x", F.lit(1)), shards=4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
