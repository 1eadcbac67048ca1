"""Hard negatives by Fagin's threshold algorithm over blocks of candidates.

A block of candidates is a list per dimension, sorted by the component. An anchor
goes down the lists of all dimensions at once, from the high end where its own
component is positive and from the low end where it is negative; every candidate
that it meets is scored. What it has not met scores no more than the threshold,
the anchor's product with the components last seen, so it stops once the
threshold is strictly below the scores it still needs to beat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .small_tables import small
from .storage import stored

#: Candidates in a block and anchors that meet it in one task, about.
BLOCK, CHUNK = 4096, 1024
#: Components are smaller than this, so that no score leaves 64 bits.
LIMIT = 2**24
#: Places of every list that an anchor looks at first; twice as many at each turn.
FIRST = 16


def integer_vector(vector: Column, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down; null unless all are usable.

    A vector that is null, or has a component that is null, not finite or (scaled)
    of ``LIMIT`` or more, gives null.
    """
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    # ``forall`` is null if a component is null and the others are usable.
    usable = F.forall(vector, lambda x: F.abs(x.cast("double") * scale) < F.lit(float(LIMIT)))
    return F.when(usable, whole)


class SortedLists:
    """The candidates of a block, sorted by every dimension."""

    def __init__(self, vectors: np.ndarray, largest: int):
        """``largest`` bounds the components of the anchors to come."""
        self.size, dimensions = vectors.shape
        bound = dimensions * largest * int(np.abs(vectors).max(initial=0))
        self.kind = np.float64 if bound < 2**53 else np.int64
        self.vectors = vectors.astype(self.kind)
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(self.vectors.T, self.order, axis=1)

    def descend(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """New candidates, their scores and the threshold, turn by turn.

        The threshold is None once every candidate has been met.
        """
        anchor = anchor.astype(self.kind)
        high, low = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        n, met, depth = self.size, np.zeros(self.size, bool), 0
        while True:
            to = min(n, 2 * depth + FIRST)
            now = np.zeros(n, bool)
            now[self.order[high, n - to : n - depth].ravel()] = True
            now[self.order[low, depth:to].ravel()] = True
            if to == n:
                now[:] = True  # also where all components of the anchor are 0
            now &= ~met
            met |= now
            new = np.flatnonzero(now)
            scores = (self.vectors[new] @ anchor).astype(np.int64)
            if met.all():
                yield new, scores, None
                return
            threshold = anchor[high] @ self.sorted[high, n - to] + anchor[low] @ self.sorted[low, to - 1]
            yield new, scores, int(threshold)
            depth = to


def nearest(lists: SortedLists, names: np.ndarray, anchor: np.ndarray, own, k: int):
    """Places and scores of the ``k`` best candidates other than ``own``; ties by name."""
    at, best = np.empty(0, np.int64), np.empty(0, np.int64)
    for new, scores, threshold in lists.descend(anchor):
        other = names[new] != own
        at, best = np.append(at, new[other]), np.append(best, scores[other])
        order = np.lexsort((names[at], -best))[:k]
        at, best = at[order], best[order]
        if threshold is not None and len(at) == k and threshold < best[-1]:
            break
    return at, best


def best_within(
    lists: SortedLists,
    names: np.ndarray,
    allowed: np.ndarray,
    anchor: np.ndarray,
    windows: list[tuple[int, int]],
    k: int,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every window of scores, ends included, places and scores of its ``k`` best
    ``allowed`` candidates; ties by name."""
    lowest, highest = min(w[0] for w in windows), max(w[1] for w in windows)
    at, best = np.empty(0, np.int64), np.empty(0, np.int64)
    found = []
    for new, scores, threshold in lists.descend(anchor):
        good = allowed[new] & (scores >= lowest) & (scores <= highest)
        at, best = np.append(at, new[good]), np.append(best, scores[good])
        order = np.lexsort((names[at], -best))
        at, best = at[order], best[order]
        found, done = [], True
        for low, high in windows:
            first = np.searchsorted(-best, -high)
            last = min(first + k, int(np.searchsorted(-best, -low, "right")))
            found.append((at[first:last], best[first:last]))
            # What is still to come must lie below the k-th score, or the window.
            least = int(best[last - 1]) if last - first == k else low
            done &= high < low or (threshold is not None and threshold < least)
        if done:
            break
    return found


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows; a shorter one ends in zeros."""
    lists = column.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.zeros((len(lists), width), np.int64)
    rows[np.arange(width) < size[:, None]] = lists.flatten().to_numpy()
    return rows


def _widest(*columns: pa.ChunkedArray) -> int:
    return max(int(c.combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for c in columns)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """Rows of another label that score nearly as high as an anchor's positives.

    ``vector`` has integers, as :func:`integer_vector` makes them; a score is the
    inner product with the anchor's. ``anchor`` tells which rows are anchors. Higher
    scores come first, ties by the smaller key. An anchor's positives are its first
    ``positives`` other rows of its label. For each of them the first ``negatives``
    rows of other labels are returned whose score is from ``low`` to ``high`` % of
    the positive's, both included: ``(anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score)``, ranks from 1. Fewer rows, or none, are
    returned where there are not as many.

    Rows without key, label or vector take no part. A key counts once, with its
    lowest label and vector; a shorter vector ends in zeros. Other columns play no
    part, so their names do not matter.

    Anchors meet the candidates in blocks: a task has one block and one chunk of
    anchors, whatever the number of rows of a label or copies of a vector. Blocks
    hold what is best in them, and the best of all blocks are ranked at the end.
    """
    rows = vectors.select(
        F.col(key).alias("id"),
        F.col(label).alias("label"),
        F.col(vector).cast("array<int>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where("id is not null and label is not null and vector is not null")
    once = rows.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("row"))
    rows = stored(once.select("id", "row.*"))
    counts = rows.agg(F.count("*"), F.count_if("anchor")).first()
    parts, chunks = max(1, -(-counts[0] // block)), max(1, -(-counts[1] // chunk))

    near = stored(_positives(rows, positives, block, chunk))
    wanted = near.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("near"))
    anchors = rows.where("anchor").join(wanted, F.col("id") == F.col("anchor_id"))

    candidates = rows.select(
        "id", "label", "vector", _part("id", parts).alias("part"), _every(chunks).alias("chunk")
    )
    # Renamed, as both sides of a cogroup come from the same table.
    anchors = anchors.select(
        "id", "label", "vector", "near", _every(parts).alias("part"), _part("id", chunks).alias("chunk")
    ).toDF("name", "kind", "own", "near", "part", "chunk")

    def mine(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in range(5)]
        if left.num_rows and right.num_rows:
            width = _widest(left["own"], right["vector"])
            own = _matrix(left["own"], width)
            lists = SortedLists(_matrix(right["vector"], width), int(np.abs(own).max(initial=0)))
            names = right["id"].to_numpy()
            kinds, code = np.unique(right["label"].to_numpy(), return_inverse=True)
            places = {k: i for i, k in enumerate(kinds.tolist())}
            for i, (name, kind, pairs) in enumerate(
                zip(*(left[c].to_pylist() for c in ("name", "kind", "near")), strict=True)
            ):
                allowed = code != places.get(kind, -1)
                windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in pairs]
                found = best_within(lists, names, allowed, own[i], windows, negatives)
                for p, (at, scores) in zip(pairs, found, strict=True):
                    n = len(at)
                    row = ([name] * n, [p["id"]] * n, names[at], [p["score"]] * n, scores)
                    for column, values in zip(out, row, strict=True):
                        column.extend(values)
        names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, out, strict=True)})

    units = ("part", "chunk")
    found = anchors.groupBy(*units).cogroup(candidates.groupBy(*units)).applyInArrow(
        mine,
        "anchor_id bigint, positive_id bigint, negative_id bigint, "
        "positive_score bigint, negative_score bigint",
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.col("negative_score").desc(), "negative_id"
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _part(key: str, parts: int | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def _every(parts: int | Column) -> Column:
    """One row per part."""
    last = F.lit(parts - 1) if isinstance(parts, int) else parts - 1
    return F.explode(F.sequence(F.lit(0), last.cast("int")))


def _positives(rows: DataFrame, k: int, block: int, chunk: int) -> DataFrame:
    """``(anchor_id, id, score)``: each anchor's ``k`` best other rows of its label.

    Blocks and chunks are of one label, as many as it needs.
    """
    sizes = rows.groupBy(F.col("label").alias("of_label")).agg(
        F.ceil(F.count("*") / block).alias("parts"),
        F.ceil(F.count_if("anchor") / chunk).alias("chunks"),
    )
    sizes = small(stored(sizes.where("chunks > 0")))
    sized = rows.join(sizes, F.col("label") == F.col("of_label"))
    candidates = sized.select(
        "id", "label", "vector", _part("id", F.col("parts")).alias("part"), _every(F.col("chunks")).alias("chunk")
    )
    anchors = sized.where("anchor").select(
        "id", "label", "vector", _every(F.col("parts")).alias("part"), _part("id", F.col("chunks")).alias("chunk")
    ).toDF("name", "kind", "own", "part", "chunk")

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in range(3)]
        if left.num_rows and right.num_rows:
            width = _widest(left["own"], right["vector"])
            own = _matrix(left["own"], width)
            lists = SortedLists(_matrix(right["vector"], width), int(np.abs(own).max(initial=0)))
            names = right["id"].to_numpy()
            for i, name in enumerate(left["name"].to_pylist()):
                at, scores = nearest(lists, names, own[i], name, k)
                for column, values in zip(out, ([name] * len(at), names[at], scores), strict=True):
                    column.extend(values)
        return pa.table(
            {n: pa.array(c, pa.int64()) for n, c in zip(("anchor_id", "id", "score"), out, strict=True)}
        )

    found = anchors.groupBy("kind", "part", "chunk").cogroup(
        candidates.groupBy("label", "part", "chunk")
    ).applyInArrow(
        find, "anchor_id bigint, id bigint, score bigint"
    )
    order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")
