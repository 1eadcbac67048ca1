import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries
from ledgerlake.llm.hard_negatives import (
    LIMIT,
    SortedLists,
    hard_negatives,
    integer_vector,
    nearest,
)

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def whole(vector):
    usable = vector is not None and all(
        x is not None and math.isfinite(x) and abs(256 * x) < LIMIT for x in vector
    )
    return [math.floor(256 * float(np.float32(x))) for x in vector] if usable else None


def by_hand(rows, relabel=True):
    """All scores of all anchors, sorted."""
    kept = {}
    for name, vector, label in rows:
        ints = whole(vector)
        if name is None or label is None or ints is None:
            continue
        if relabel and name % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        kept[name] = min(kept.get(name, (label, ints)), (label, ints))
    out = set()
    for anchor, (label, ints) in kept.items():
        if anchor % 50:
            continue
        scores = [(-sum(x * y for x, y in zip(ints, v)), n, kind) for n, (kind, v) in kept.items() if n != anchor]
        scores.sort()
        for p, positive, _ in [s for s in scores if s[2] == label][:5]:
            good = [
                s for s in scores if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p
            ][:3]
            out |= {(anchor, positive, i + 1, s[1], -p, -s[0]) for i, s in enumerate(good)}
    return out


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def cloud(n, seed, labels=4, dims=8, decimals=2):
    """Vectors near a centre per label, with many ties and copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (labels, dims))
    rows = []
    for i in range(n):
        label = 0 if i % 3 == 0 else int(rng.integers(labels))
        vector = np.round(centres[label] + rng.normal(0, 0.7, dims), decimals)
        if i % 11 == 0:
            vector = np.round(centres[0], decimals)  # one vector that very many rows have
        rows.append((i, [float(np.float32(x)) for x in vector], label))
    return rows


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    vectors = table.select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        integer_vector(F.col("embedding")).alias("vector"),
    )
    return found(hard_negatives(vectors, F.col("vec_id") % 50 == 0, **options))


@pytest.mark.parametrize("options", [{}, {"block": 40, "chunk": 3}])
def test_against_all_scores(spark, options):
    rows = cloud(900, 1)
    want = by_hand(rows)
    assert len(want) > 100
    assert mined(spark, rows, **options) == want


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, scale):
    path = f"/root/testdata/{scale}"
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    want = connection.sql(queries.oracle_sql()["op13_hard_negatives"])
    assert sorted(want.columns) == sorted(COLUMNS)
    place = [want.columns.index(c) for c in COLUMNS]
    rows = {tuple(r[i] for i in place) for r in want.fetchall()}
    assert rows and found(queries.op13_hard_negatives(spark, path)) == rows


def test_odd_rows(spark, tmp_path):
    ten = [[float(i % 5), 1.0, -0.5, 0.25] for i in range(120)]
    rows = [(i, v, i % 3) for i, v in enumerate(ten)]
    rows += [(i, v, i % 3) for i, v in enumerate(ten[:30])]  # repeated rows
    rows += [
        (None, ten[0], 1), (200, None, 1), (250, ten[1], None), (300, [1.0, None, 2.0, 1.0], 0),
        (350, [1.0, math.nan, 2.0, 1.0], 0), (400, [math.inf, 1.0, 1.0, 1.0], 0),
        (450, [3e30, 1.0, 1.0, 1.0], 0), (500, [], 1), (550, [0.0] * 4, 2), (600, [2.0, 2.0], 1),
        (650, [1.0] * 4, 77), (700, [-5.0, -1.0, 0.5, 0.5], -9), (701, [-4.0, -1.0, 0.5, 0.5], 3),
        (51, [1.0, 9.0, 1.0, 1.0], 2), (750, [1.0] * 40, 0), (800, [65535.0, -65535.0, 0.1, 0.1], 1),
    ]
    want = by_hand(rows)
    assert mined(spark, rows) == want
    assert {a for a, *_ in want} >= {0, 50, 100}
    table = spark.createDataFrame(rows, SCHEMA)
    extra = table.withColumns({c: F.lit("x") for c in ("id", "anchor", "part", "chunk", "near", "score", "vector", "LABEL_")})
    extra.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert found(queries.op13_hard_negatives(spark, str(tmp_path))) == want


@pytest.mark.parametrize(
    "rows", [[], [(50, [1.0], 1)], [(1, [1.0], 1), (2, [2.0], 2)], [(0, [1.0], 1), (50, [2.0], 1)]]
)
def test_too_few_rows(spark, rows):
    assert mined(spark, rows) == set()


def test_stops_early_and_strictly():
    rng = np.random.default_rng(2)
    vectors = np.zeros((20_000, 3), np.int64)
    vectors[:, 0] = rng.permutation(20_000)
    vectors[:, 1] = vectors[:, 0] // 2
    vectors[:40] = (30_000, 15_000, 0)  # forty equal best rows
    lists, names = SortedLists(vectors, 5), rng.permutation(20_000)
    turns = list(lists.descend(np.array([3, 1, 0])))
    assert sum(len(new) for new, _, _ in turns) == 20_000 and turns[-1][2] is None
    looked = 0

    class Counting(SortedLists):
        def descend(self, anchor):
            nonlocal looked
            for turn in super().descend(anchor):
                looked += len(turn[0])
                yield turn

    at, scores = nearest(Counting(vectors, 5), names, np.array([3, 1, 0]), -1, 5)
    assert names[at].tolist() == sorted(names[:40].tolist())[:5] and set(scores) == {105_000}
    assert 40 <= looked < 500
    at, scores = nearest(lists, names, np.array([-3, 0, 0]), -1, 2)  # the low end
    assert vectors[at, 0].tolist() == sorted(vectors[:, 0])[:2]
    assert np.all(nearest(lists, names, np.zeros(3, np.int64), -1, 3)[1] == 0)
