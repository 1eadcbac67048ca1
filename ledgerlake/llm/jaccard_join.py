"""Parity-sketch join: documents whose shingle sets have a high Jaccard likeness.

A set's sketch is a row of bits; every shingle flips one, so two sketches differ
in at most as many bits as the symmetric difference of the sets has members. For
a likeness of ``percent`` or more that difference is bounded by the sizes. The
sketch of a size band is cut into more pieces than that bound, so two similar
sets agree in some piece: equal pieces are joined, and every pair found that way
is verified on the sets themselves.

Only as many pieces are joined as the bound requires: with ``spare`` pieces more
than needed, each set leaves out the ``spare`` pieces with the fewest bits. Of
the pieces two similar sets agree in, there are more than ``spare``, and both
leave out the same ones among them, so at least one is joined. This keeps empty
and nearly empty pieces, which any two documents may share, out of the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .set_store import write_sets
from .small_tables import small
from .storage import is_mounted, release, stored
from .text import WordHashes, mix, signed, slices, windows, with_columns, words

#: A band's largest size over its smallest.
BAND_RATIO = 1.4
#: Spare pieces per piece needed.
SPARE = 0.25
#: Entries a task holds before it deals them out; sets of a piece compared at a
#: time; rows in a group of such comparisons.
FLUSH, BLOCK, GROUP = 500_000, 512, 20_000
#: Blocks from which on they grow, and the sets that one then holds at most, about.
FEW_BLOCKS, LARGEST_BLOCK = 8, 16_384


def shingles(text: str | None, n: int, cache: WordHashes) -> np.ndarray:
    """Distinct hashes of ``n`` words in a row, ascending.

    Fewer words form one shingle; without words there is none.
    """
    hashes = cache.of(words(text))
    if not len(hashes):
        return hashes
    if len(hashes) < n:
        whole = windows(hashes, len(hashes))
        return mix(whole + np.uint64(len(hashes)))
    return np.unique(windows(hashes, n))


def set_id(members: np.ndarray) -> int:
    """A 64-bit name that equal sets share."""
    a = mix(members + np.uint64(0x9E3779B97F4A7C15))
    return int(signed(mix(np.array([a.sum() ^ mix(a).sum()], np.uint64)))[0])


def bands(percent: int, largest: int) -> list[tuple[int, int]]:
    """Lower ends of the size bands, and the pieces each needs."""
    found, low = [], 1
    while low <= largest:
        high = max(low, int(low * BAND_RATIO))
        bound = 2 * high * (100 - percent) // (100 + percent)
        found.append((low, bound + 1))
        low = high + 1
    return found


def pieces(members: np.ndarray, percent: int, band_list: list[tuple[int, int]]) -> list[np.ndarray]:
    """Keys of the pieces to join: for the set's band, and for each larger one in
    which a set can be similar."""
    size = len(members)
    lows = [low for low, _ in band_list]
    home = int(np.searchsorted(lows, size, "right")) - 1
    found = []
    for band in range(home, len(band_list)):
        if band > home and 100 * size < percent * lows[band]:
            break
        needed = band_list[band][1]
        spare = int(needed * SPARE)
        count = needed + spare
        place = ((members >> np.uint64(32)) % np.uint64(count)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        bits = mix(members[order])
        filled, first = np.unique(place[order], return_index=True)
        content = np.zeros(count, np.uint64)
        if len(filled):
            content[filled] = np.bitwise_xor.reduceat(bits, first)
        weight = np.bincount(place, minlength=count)
        used = np.argsort(weight, kind="stable")[spare:].astype(np.uint64)
        name = mix(used + np.uint64((band + 1) << 32))
        found.append(mix(content[used.astype(np.int64)] ^ name))
    return found


def _sized(documents: DataFrame, key: str, text: str, n: int) -> DataFrame:
    added = T.StructType(
        [T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.LongType())]
    )

    def make():
        cache = WordHashes()

        def compute(texts):
            sets = [shingles(x, n, cache) for x in texts]
            return [[len(s) for s in sets], [set_id(s) if len(s) else None for s in sets]]

        return compute

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    text_id = F.xxhash64("text").alias("text_id")
    return with_columns(rows, "text", make, added).select("key", text_id, "n_shingles", "set_id")


def _shared_pieces(
    documents: DataFrame, text: str, n: int, percent: int, largest: int, tokens: int
) -> DataFrame:
    """``(piece, set_id)`` for every piece that two or more different sets share.

    Tasks deal their pieces by key to shards, as sorted arrays. Of the sets that
    share a piece within a task one goes to the piece's shard; the others are
    known to be shared and travel to shards in turn. So a piece that very many
    sets have reaches its shard once per task.
    """
    band_list = bands(percent, largest)
    shards = max(1, tokens // 2_000_000)
    schema = "shard int, known boolean, pieces binary, sets binary, more binary"

    def deal(keys: np.ndarray, sets: np.ndarray, turn: int) -> pa.RecordBatch:
        order = np.lexsort((sets, keys))
        keys, sets = keys[order], sets[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])
        keys, sets = keys[new], sets[new]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        last = np.ones(len(keys), bool)
        last[:-1] = first[1:]
        more = ~last[first]  # this key has further sets in this task
        k, s = keys[first], sets[first]
        shard = (k % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        rows = []
        for i in range(shards):
            part = order[cuts[i] : cuts[i + 1]]
            if len(part):
                rows.append((i, False, k[part].tobytes(), s[part].tobytes(), more[part].tobytes()))
        k, s = keys[~first], sets[~first]
        step = max(1, -(-len(k) // shards))
        for i in range(0, len(k), step):
            to = (turn + i // step) % shards
            rows.append((to, True, k[i : i + step].tobytes(), s[i : i + step].tobytes(), b""))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["shard", "known", "pieces", "sets", "more"],
        )

    def map_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        keys, sets, held, turn = [], [], 0, 0
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                members = shingles(value, n, cache)
                if not len(members):
                    continue
                name = np.uint64(set_id(members) & 0xFFFFFFFFFFFFFFFF)
                for found in pieces(members, percent, band_list):
                    keys.append(found)
                    sets.append(np.full(len(found), name, np.uint64))
                    held += len(found)
                if held >= FLUSH:
                    yield deal(np.concatenate(keys), np.concatenate(sets), turn)
                    keys, sets, held, turn = [], [], 0, turn + 1
        if held:
            yield deal(np.concatenate(keys), np.concatenate(sets), turn)

    def merge(table):
        passed, keys, sets, more = [], [], [], []
        for known, k, s, m in zip(*(table.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
            k, s = np.frombuffer(k, np.uint64), np.frombuffer(s, np.uint64)
            if known:
                passed.append((k, s))
            else:
                keys.append(k)
                sets.append(s)
                more.append(np.frombuffer(m, bool))
        if keys:
            k, s, m = map(np.concatenate, (keys, sets, more))
            order = np.argsort(k, kind="stable")
            k, s, m = k[order], s[order], m[order]
            start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            length = np.diff(np.append(start, len(k)))
            # Shared: a task had more sets of this piece, or the tasks' sets differ.
            lowest, highest = np.minimum.reduceat(s, start), np.maximum.reduceat(s, start)
            shared = np.logical_or.reduceat(m, start) | (lowest != highest)
            chosen = np.repeat(shared, length)
            passed.append((k[chosen], s[chosen]))
        both = [signed(np.concatenate([p[i] for p in passed])) for i in (0, 1)]
        return pa.table({"piece": pa.array(both[0]), "set_id": pa.array(both[1])})

    dealt = documents.select(F.col(text).alias("text")).mapInArrow(map_side, schema)
    found = dealt.groupBy("shard").applyInArrow(merge, "piece bigint, set_id bigint")
    return found.distinct()


def _sets(documents: DataFrame, wanted: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """``(set_id, members, sketch)`` of the stored ``wanted (set_id, key)``.

    Only the texts of these keys are looked at; texts are shuffled only if the
    keys are too many to broadcast. Rows that repeat a key, with a text of the
    same set, give it again; see :func:`_once`.
    """
    keys = wanted.select(F.col("set_id").alias("wanted_set"), F.col("key").alias("wanted_key"))
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.join(small(keys), F.col("key").eqNullSafe(F.col("wanted_key"))).drop("wanted_key")
    added = T.StructType(
        [
            T.StructField("set_id", T.LongType()),
            T.StructField("members", T.ArrayType(T.LongType())),
            T.StructField("sketch", T.BinaryType()),
        ]
    )

    def make():
        cache = WordHashes()

        def compute(texts):
            sets = [shingles(x, n, cache) for x in texts]
            return [
                [set_id(s) if len(s) else None for s in sets],
                [signed(s) for s in sets],
                [sketch(s) for s in sets],
            ]

        return compute

    found = with_columns(rows, "text", make, added).where("set_id = wanted_set")
    return found.select("set_id", "members", "sketch")


def _once(sets: DataFrame) -> DataFrame:
    """The stored ``sets`` with each ``set_id`` once. They are shuffled only if
    some repeat, which unique keys rule out."""
    if sets.groupBy("set_id").count().where("count > 1").isEmpty():
        return sets
    return stored(sets.dropDuplicates(["set_id"]))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar."""
    left = sets.select(F.col("set_id").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("set_id").alias("b"), F.col("members").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b")


def sketch(members: np.ndarray) -> bytes:
    """A parity bit per hash value modulo a power of two, two to four bits a member."""
    bits = max(64, 1 << int(2 * len(members) - 1).bit_length())
    odd = np.bincount((members % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches of different lengths as rows of the shortest one's length.

    Folding a sketch in half adds up parities, so the distance of two folded
    sketches still bounds the symmetric difference from below.
    """
    width = min(map(len, sketches))
    rows = []
    for s in sketches:
        bits = np.frombuffer(s, np.uint64)
        rows.append(np.bitwise_xor.reduce(bits.reshape(-1, width // 8), axis=0))
    return np.stack(rows)


def _allowed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The largest symmetric difference that sets of these sizes may have."""
    both = a + b
    return both - 2 * -(-percent * both // (100 + percent))


def _sketched(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that sizes and sketches allow: far less to verify, and
    a sketch is a small part of a set."""
    thin = sets.select("set_id", F.size("members").cast("long").alias("size"), "sketch")
    left = thin.withColumnsRenamed({"set_id": "a", "size": "size_a", "sketch": "sketch_a"})
    right = thin.withColumnsRenamed({"set_id": "b", "size": "size_b", "sketch": "sketch_b"})

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            a, b = batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist()
            sizes = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            most = _allowed(*sizes, percent)
            widths = np.array([[len(x), len(y)] for x, y in zip(a, b, strict=True)])
            kept = np.zeros(len(a), bool)
            for x, y in np.unique(widths, axis=0).tolist() if len(a) else []:
                at = np.flatnonzero((widths == (x, y)).all(1))
                width = min(x, y) // 8
                rows = (
                    np.bitwise_xor.reduce(
                        np.frombuffer(b"".join(s[i] for i in at), np.uint64).reshape(len(at), -1, width), axis=1
                    )
                    for s in (a, b)
                )
                kept[at] = np.bitwise_count(np.bitwise_xor(*rows)).sum(1) <= most[at]
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    smaller, larger = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    joined = pairs.join(left, "a").join(right, "b").where(100 * smaller >= percent * larger)
    return joined.mapInArrow(near, "a bigint, b bigint")


def _open_pieces(others: DataFrame, merged: DataFrame) -> DataFrame:
    """``(piece, set_id, component)`` of the pieces whose other sets are not all in one component.

    ``others (piece, set_id)`` has the sets of a piece but the one that they were all
    compared with: a piece of two sets is settled, whether they are similar or not.
    """
    placed = others.join(merged, F.col("set_id") == F.col("node"), "left").select(
        "piece", "set_id", F.coalesce("component", "set_id").alias("component")
    )
    ends = placed.groupBy("piece").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(ends.where("low <> high").select("piece"), "piece", "left_semi")


def _together(members: DataFrame) -> DataFrame:
    """``(together, set_id, component)``: which sets to compare with each other.

    ``members (piece, set_id, component)`` has the pieces that are left with several
    components. Sets that share pieces, directly or through others, form a cluster; within
    it, the sets of the pieces that have the same lowest set form a star. Near copies share
    so many pieces that comparing a star's sets once is far less than comparing those of
    every piece, and so for a cluster's. But the more sets there are, the looser are the
    clusters. So a star's sets are compared together or, where it is so loose that its pieces
    are less work, piece by piece; and a cluster's together where that is no more work
    than its stars.
    """
    lowest = members.groupBy("piece").agg(F.min("set_id").alias("a"))
    starred = stored(members.join(lowest, "piece"))
    links = starred.where(F.col("a") != F.col("set_id")).select("a", F.col("set_id").alias("b"))
    clusters = components(links.distinct())
    clusters = stored(clusters.withColumnRenamed("component", "cluster"))
    placed = stored(starred.join(clusters, F.col("set_id") == F.col("node")).drop("node"))

    def squares(*keys: str) -> DataFrame:
        return placed.groupBy(*keys).agg(F.pow(F.count_distinct("set_id"), F.lit(2)).alias("pairs"))

    by_piece = squares("cluster", "a", "piece").groupBy("cluster", "a").agg(F.sum("pairs").alias("by_piece"))
    stars = squares("cluster", "a").join(by_piece, ["cluster", "a"])
    stars = stored(
        stars.select(
            "cluster",
            "a",
            (F.col("pairs") <= F.col("by_piece")).alias("star"),
            F.least("pairs", "by_piece").alias("least"),
        )
    )
    by_star = stars.groupBy("cluster").agg(F.sum("least").alias("by_star"))
    chosen = squares("cluster").join(by_star, "cluster")
    chosen = chosen.select("cluster", (F.col("pairs") <= F.col("by_star")).alias("whole"))
    together = (
        F.when(F.col("whole"), F.xxhash64(F.lit("cluster"), "cluster"))
        .when(F.col("star"), F.xxhash64(F.lit("star"), "a"))
        .otherwise(F.xxhash64(F.lit("piece"), "piece"))
    )
    marked = placed.join(stars.select("cluster", "a", "star"), ["cluster", "a"])
    marked = marked.join(small(stored(chosen)), "cluster")
    found = stored(marked.select(together.alias("together"), "set_id", "component").distinct())
    release(members.sparkSession, starred, placed)
    return found


def _links_between(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored links ``(a, b)`` between sets of different components that are compared together.

    ``members`` is :func:`_together`'s result. Its groups are dealt to blocks of
    ``BLOCK`` sets or, if these were more than ``FEW_BLOCKS``, of up to ``LARGEST_BLOCK``,
    since a set's sketch goes to every other block; a unit holds two blocks of a group,
    compares their sketches and verifies what these allow on the sets themselves. It yields only links that join
    components which it has not yet seen joined, so there are fewer links than sets
    in a unit, whatever the number of similar pairs. Units are gathered to groups of
    about ``GROUP`` rows. The sets are read from files where the shared folder is
    mounted; elsewhere they travel with their sketches.
    """
    count = F.count("*")
    blocks = F.least(F.ceil(count / BLOCK), FEW_BLOCKS + F.floor(count / LARGEST_BLOCK))
    sizes = members.groupBy("together").agg(blocks.cast("int").alias("blocks"))
    rows = sizes.join(members, "together").agg(F.sum("blocks")).first()[0]
    groups = max(1, -(-(rows or 0) // GROUP))
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    names = stored(members.select(F.col("set_id").alias("name")).distinct())
    needed = sets.join(small(names), F.col("set_id") == F.col("name"), "left_semi")
    needed = needed.select("set_id", F.size("members").alias("size"), "sketch", "members")
    if is_mounted(sets.sparkSession):
        store, needed = write_sets(needed)
        thin = stored(needed, texts=True)
        where = ["file", "place"]
    else:
        store, thin, where = None, needed, ["members"]
    low, high = F.least("block", "other"), F.greatest("block", "other")
    # The sketches come last, so that only the last shuffle carries them.
    dealt = (
        members.join(sizes, "together")
        .withColumn("block", block)
        .withColumn("other", other)
        .withColumn("unit", F.xxhash64("together", low, high))
        .join(thin, "set_id")
        .select(
            F.pmod("unit", F.lit(groups)).alias("group"),
            "unit",
            (F.col("block") <= F.col("other")).alias("left"),
            (F.col("block") >= F.col("other")).alias("right"),
            "set_id",
            "component",
            "size",
            "sketch",
            *where,
        )
    )

    def compare(table):
        unit, left, right, name, component, size = (
            table.column(c).to_numpy()
            for c in ("unit", "left", "right", "set_id", "component", "size")
        )
        bits = table.column("sketch").to_pylist()
        if store:
            file, place = (table.column(c).to_numpy() for c in where)

        def of(i: int) -> np.ndarray:
            if store:
                return store.get(int(file[i]), int(place[i]))
            return table.column("members")[int(i)].values.to_numpy().view(np.uint64)

        order = np.argsort(unit, kind="stable")
        cuts = np.flatnonzero(np.diff(unit[order])) + 1
        found = []
        for part in np.split(order, cuts):
            if len(part) < 2 or (component[part] == component[part[0]]).all():
                continue
            rows, sizes = folded([bits[i] for i in part]), size[part]
            _, joined = np.unique(component[part], return_inverse=True)
            to = np.flatnonzero(right[part])
            for x in np.flatnonzero(left[part]):
                most = _allowed(sizes[to], sizes[x], percent)
                near = (joined[to] != joined[x]) & (np.abs(sizes[to] - sizes[x]) <= most)
                y, most = to[near], most[near]
                y = y[np.bitwise_count(rows[y] ^ rows[x]).sum(1) <= most]
                own = of(part[x]) if len(y) else None
                for i in y.tolist():
                    if joined[i] != joined[x] and _similar(own, of(part[i]), percent):
                        found.append(sorted((int(name[part[x]]), int(name[part[i]]))))
                        joined[joined == joined[i]] = joined[x]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    links = stored(dealt.groupBy("group").applyInArrow(compare, "a bigint, b bigint").distinct())
    release(sets.sparkSession, store, thin)
    return links


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending arrays are similar enough."""
    at = np.searchsorted(x, y)
    both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def jaccard_components(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Group documents by links of at least ``percent`` % Jaccard likeness.

    Returns ``(key, n_shingles, component)``: one row per input row;
    ``component`` is the smallest key that links lead to. Shingles are ``n``
    words in a row, A-Z in lower case; a shorter text is one shingle. A text
    without words has no shingle and links with nothing: its component is its
    own key. Equal sets are one class, found by grouping, and only classes are
    compared. Repeated rows and keys fall into one class each; a null key is
    taken as it is and never the smallest, unless a component has no other.

    The join is complete: for every link between different sets the two sets
    end up in one component, through that link or through others.
    """
    rows = _grouped(documents, key, text, n, percent)
    return rows.select(F.col("key").alias(key), "n_shingles", "component")


def _grouped(documents: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """``(key, text_id, n_shingles, set_id, class, component)``, one row per input row.

    ``class`` names the group (null without words); several groups may have the
    same smallest key, if keys repeat. ``text_id`` is a hash of the text.
    """
    rows = stored(_sized(documents, key, text, n), texts=True)
    classes = rows.where("set_id is not null").groupBy("set_id").agg(
        F.min("key").alias("key"), F.max("n_shingles").alias("n_shingles")
    )
    size = rows.agg(F.max("n_shingles"), F.sum("n_shingles")).first()
    merged = None
    if size[0]:
        members = stored(_shared_pieces(documents, text, n, percent, size[0], size[1]), texts=True)
        # Every set of a piece is compared with the lowest; what is left lies between the others.
        lowest = members.groupBy("piece").agg(F.min("set_id").alias("a"))
        others = stored(members.join(lowest, "piece").where(F.col("a") != F.col("set_id")))
        stars = others.select("a", F.col("set_id").alias("b")).distinct()
        wanted = stored(members.select("set_id").distinct().join(classes, "set_id"))
        release(documents.sparkSession, members)
        sets = _once(stored(_sets(documents, wanted, key, text, n), texts=True))
        links = stored(_verified(_sketched(stars, sets, percent), sets, percent))
        merged = stored(components(links))

        left = stored(_open_pieces(others, merged))
        if not left.isEmpty():
            more = _links_between(_together(left), sets, percent)
            merged = stored(components(links.unionByName(more)))
        # Large, and behind all that is left to do.
        release(documents.sparkSession, others, sets, left)

    if merged is not None:
        smallest = (
            classes.join(merged, F.col("set_id") == F.col("node"), "left")
            .select("set_id", "key", F.coalesce("component", "set_id").alias("class"))
        )
        tops = smallest.groupBy("class").agg(F.min("key").alias("component"))
        named = smallest.select("set_id", "class").join(tops, "class")
        rows = rows.join(named, "set_id", "left")
    else:
        rows = rows.withColumns({"class": F.lit(None).cast("long"), "component": F.col("key")})
    alone = F.when(F.col("set_id").isNull(), F.col("key")).otherwise(F.col("component"))
    return rows.select("key", "text_id", "n_shingles", "set_id", "class", alone.alias("component"))


def near_duplicates_removed(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Keep one document of each group: the one with the smallest key.

    Decided by key and text: of a group's texts under its smallest key the one
    with the lowest hash stays, and unlike texts under one key are decided each
    on their own. Of rows that repeat a kept key and text one stays, the lowest
    by a hash of all columns. Texts without words form no group and all stay.
    Rows with a null key stay as they are, unless their group has a key.
    """
    groups = _grouped(documents, key, text, n, percent).where(F.col("key").eqNullSafe(F.col("component")))
    once = F.col("set_id").isNotNull() & F.col("key").isNotNull()
    kept = (
        groups.withColumn("_ll_once", once)
        .groupBy(
            "_ll_once",
            F.when(once, F.col("class")).alias("of_class"),
            F.when(~once, F.struct("key", "text_id")).alias("of_row"),
        )
        .agg(
            F.min("key").alias("_ll_kept_key"),
            F.min("text_id").alias("_ll_kept_text"),
            F.count("*").alias("_ll_rows"),
        )
        .drop("of_class", "of_row")
    )
    kept = stored(kept)
    same = F.col(key).eqNullSafe(F.col("_ll_kept_key")) & (F.xxhash64(text) == F.col("_ll_kept_text"))
    rows = documents.join(kept.drop("_ll_rows"), same)
    if kept.where("_ll_once and _ll_rows > 1").isEmpty():
        return rows.select(*documents.columns)  # no key repeats, so texts are shuffled once
    # Maps can't be hashed.
    others = [c for c, kind in documents.dtypes if "map<" not in kind and "variant" not in kind]
    order = Window.partitionBy("_ll_kept_key", "_ll_kept_text").orderBy(F.xxhash64(*others))
    grouped = rows.where("_ll_once").withColumn("_ll_place", F.row_number().over(order))
    grouped = grouped.where("_ll_place = 1").drop("_ll_place")
    return grouped.unionByName(rows.where("not _ll_once")).select(*documents.columns)
