from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard_join
from ledgerlake.llm.components import components
from ledgerlake.llm.jaccard_join import (
    _once,
    _sets,
    _sized,
    _together,
    bands,
    folded,
    jaccard_components,
    near_duplicates_removed,
    pieces,
    sketch,
)
from ledgerlake.llm.set_store import write_sets
from ledgerlake.llm.storage import stored
from ledgerlake.llm.text import mix

from .data import SCHEMA, empty, odd, odd_rows, prose


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, percent):
    """Component per row, by comparing all pairs."""
    sets = [shingle_set(text, n) for _, text in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    found = Counter()
    for i, (key, _) in enumerate(rows):
        keys = [k for k in least[find(i)] if k is not None]
        found[key, len(sets[i]), min(keys) if keys and sets[i] else key] += 1
    return found


def chains(seed):
    """Families around the threshold: chains of edits, stars, and subsets."""
    rng = np.random.default_rng(seed)
    rows, key = [], 0
    for family in range(25):
        base = prose(int(rng.integers(6, 160)), (seed, family).__hash__()).split()
        text = list(base)
        for step in range(int(rng.integers(1, 14))):
            rows.append((key, " ".join(text)))
            key += 1
            text = list(text if family % 2 else base)
            for _ in range(1 + step % 3):
                at = int(rng.integers(0, len(text)))
                if rng.random() < 0.3 and len(text) > 4:
                    del text[at]
                else:
                    text[at] = f"w{rng.integers(50)}"
    return rows


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 50)])
def test_against_all_pairs(spark, n, percent):
    rows = chains(n)
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = Counter(map(tuple, jaccard_components(table, n=n, percent=percent).collect()))
    assert got == brute(rows, n, percent)


def test_odd_rows(spark):
    table = odd(spark, set_id=1, component=2, n_shingles="x", key=3)
    got = Counter(map(tuple, jaccard_components(table, n=3, percent=90).collect()))
    assert got == brute([r[:2] for r in odd_rows()], 3, 90)


def test_empty(spark):
    assert jaccard_components(empty(spark)).count() == 0
    assert near_duplicates_removed(empty(spark)).count() == 0


def test_one_stays_of_each_group(spark):
    rows = [(k, t, "en", "s", 1) for k, t in chains(9)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("component", F.lit(1))
    kept = near_duplicates_removed(table, n=5, percent=80)
    assert kept.columns == table.columns
    want = {c for _, _, c in brute([r[:2] for r in rows], 5, 80)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_odd_rows_removed(spark):
    kept = near_duplicates_removed(odd(spark)).collect()
    keys = Counter(r["doc_id"] for r in kept)
    # 5, 6 (twice) and 7 are a group; texts without words all stay.
    assert keys == Counter({None: 2, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 1, 9: 1, 10: 1, -11: 1})


def test_unlike_texts_under_one_key_all_stay(spark):
    first, second, third = prose(80, 51), prose(80, 52), prose(80, 53)
    rows = [
        (1, first, "en", "a", 1),
        (1, second, "en", "b", 2),  # unlike the first
        (1, second, "en", "c", 3),  # its text again
        (2, second + " tail", "en", "d", 4),
        (3, third, "en", "e", 5),
        (3, " \n", "en", "f", 6),  # without words
        (3, third, "en", "e", 5),
        (4, first, "en", "g", 7),
        (None, third, "en", "h", 8),
    ]
    results = set()
    for parts in (1, 2, 3, 5):
        table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        results.add(tuple(sorted(tuple(r) for r in near_duplicates_removed(table).collect())))
    (kept,) = results  # the same whatever the partitions
    assert Counter((r[0], r[1]) for r in kept) == Counter([(1, first), (1, second), (3, third), (3, " \n")])


def test_sets_of_repeated_rows_come_once(spark):
    rows = [(i % 4, prose(80, i % 4), "en", "a", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    sized = _sized(docs, "doc_id", "text", 5)
    wanted = stored(sized.select("set_id", "key").distinct())
    sets = stored(_sets(docs, wanted, "doc_id", "text", 5))
    assert sets.count() == 20 and _once(sets).count() == 4
    assert _once(_once(sets)).count() == 4


def test_similar_sets_share_a_piece():
    """For every number of changes that the likeness allows."""
    rng = np.random.default_rng(1)
    for percent in (50, 80, 90):
        band_list = bands(percent, 600)
        for _ in range(300):
            size = int(rng.integers(1, 400))
            a = mix(rng.integers(0, 2**63, size, dtype=np.uint64))
            drop = int(rng.integers(0, size))
            b = np.concatenate([a[drop:], mix(rng.integers(0, 2**63, int(rng.integers(0, size // 3 + 1)), dtype=np.uint64))])
            both, union = size - drop, drop + len(b)
            if 100 * both >= percent * union:
                x, y = (np.concatenate(pieces(np.sort(s), percent, band_list)) for s in (a, b))
                assert len(np.intersect1d(x, y))
            rows = folded([sketch(a), sketch(b)])
            assert np.bitwise_count(rows[0] ^ rows[1]).sum() <= union - both


def test_components(spark):
    path = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 199)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 150: 150, 199: 150, 200: 150}


def near_group(n, links):
    """``n`` texts that share a passage, most pairs a little under 80 %; some are linked."""
    base = prose(300, 77).split()
    rows = []
    for i in range(n):
        own = [f"w{i}x{k}" for k in range(40)]
        rows.append((i, " ".join(base + own), "en", "a", 0))
    for i in range(links):  # a copy of a part of the group with fewer words changed
        text = rows[i][1].split()
        rows.append((n + i, " ".join([*text[:-8], *(f"v{i}y{k}" for k in range(8))]), "en", "a", 0))
    return rows


@pytest.mark.parametrize("mounted,few", [(True, 8), (False, 2)])
def test_near_group_yields_spanning_links_only(spark, monkeypatch, mounted, few):
    rows = near_group(160, 25)
    monkeypatch.setattr(jaccard_join, "FEW_BLOCKS", few)
    monkeypatch.setattr(jaccard_join, "is_mounted", lambda spark: mounted)
    monkeypatch.setattr(jaccard_join, "BLOCK", 40)
    made = []
    between = jaccard_join._links_between

    def counted(members, sets, percent):
        links = stored(between(members, sets, percent))
        made.append((links.count(), members.count()))
        return links

    monkeypatch.setattr(jaccard_join, "_links_between", counted)
    table = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = {(r["doc_id"], r["component"]) for r in jaccard_components(table, n=5, percent=80).collect()}
    want = {(k, c) for k, _, c in brute([r[:2] for r in rows], 5, 80)}
    assert got == want and 100 < len({c for _, c in want}) < 185
    assert all(links < rows for links, rows in made)


def family_chain(n):
    """Pieces of ``n`` families of four sets with 30 pieces in common; one more piece joins each to the next."""
    rows = [(100 * f + p, 4 * f + k, 4 * f + k) for f in range(n) for p in range(30) for k in range(4)]
    return rows + [(100 * f + 50, 4 * f + k, 4 * f + k) for f in range(n - 1) for k in (3, 4)]


def test_loose_clusters_are_compared_star_by_star(spark):
    made = {}
    for n in (5, 60):
        rows = family_chain(n)
        members = spark.createDataFrame(rows, "piece bigint, set_id bigint, component bigint").repartition(3)
        groups, asked = {}, {}
        for r in _together(members).collect():
            groups.setdefault(r["together"], set()).add(r["set_id"])
        for piece, member, _ in rows:
            asked.setdefault(piece, set()).add(member)
        # No pair of a piece is lost, and near copies are not compared for each of their pieces.
        assert all(any(sets <= g for g in groups.values()) for sets in asked.values())
        made[n] = sum(map(len, groups.values()))
    assert made[60] <= 2 * 60 * 4 and made[60] <= 15 * made[5]


def test_settled_pieces_are_not_compared_again(spark, monkeypatch):
    """A piece of two sets is settled, though they are unlike; one more set leaves a pair."""
    asked = []
    together = jaccard_join._together

    def counted(members):
        asked.append({(r["piece"], r["set_id"]) for r in members.collect()})
        return together(members)

    monkeypatch.setattr(jaccard_join, "_together", counted)
    for n in (2, 3):
        rows = near_group(n, 0)
        found = jaccard_components(spark.createDataFrame(rows, SCHEMA), n=5, percent=80).collect()
        assert len({r["component"] for r in found}) == n
    (left,) = asked
    assert len({s for _, s in left}) == 2 and len(left) == 2 * len({p for p, _ in left})


def test_set_store(spark):
    rows = [(i - 50, sorted(int(x) for x in np.random.default_rng(i).integers(1, 9**9, i % 7))) for i in range(100)]
    table = spark.createDataFrame(rows, "set_id bigint, members array<bigint>").repartition(3)
    store, placed = write_sets(table, file_members=20)
    placed = stored(placed).collect()
    assert len({r["file"] for r in placed}) >= 3
    assert {r["set_id"]: store.get(r["file"], r["place"]).tolist() for r in placed} == dict(rows)
