"""Logistic regression over hashed word and character n-grams.

A document's features are the shares of its n-grams that fall into each of
``2**BITS`` buckets, so its score is the mean weight of its n-grams. The model
is trained on a bounded sample of labelled documents and calibrated on a part of
the sample that training does not see.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import BLANKS, WordHashes, mix, words

BITS = 18
WORD_GRAMS = (1, 2)
CHAR_GRAMS = (1, 3)


def buckets(text: str | None, cache: WordHashes) -> list[np.ndarray]:
    """The bucket of every n-gram, one array per kind of n-gram."""
    hashes = cache.of(words(text, lower=False))
    chars = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = mix(chars.astype(np.uint64) + np.uint64(1 << 40))
    found = []
    for kind, (values, n) in enumerate(
        [(hashes, n) for n in WORD_GRAMS] + [(chars, n) for n in CHAR_GRAMS]
    ):
        count = max(0, len(values) - n + 1)
        total = values[:count] * np.uint64(2 * kind + 0x9E3779B97F4A7C15)
        for i in range(1, n):
            total = (total + values[i : i + count]) * np.uint64(2 * i + 0xC2B2AE3D27D4EB4F)
        found.append((total >> np.uint64(64 - BITS)).astype(np.int32))
    return found


def features(text: str | None, cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in ascending order and their shares, summed over the kinds."""
    index, value = [], []
    for found in buckets(text, cache):
        if len(found):
            kinds, counts = np.unique(found, return_counts=True)
            index.append(kinds)
            value.append(counts / len(found))
    if not index:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    kinds, place = np.unique(np.concatenate(index), return_inverse=True)
    return kinds.astype(np.int32), np.bincount(place, np.concatenate(value)).astype(np.float32)


@dataclass(frozen=True)
class LinearModel:
    """Weights per bucket; ``slope`` and ``shift`` turn a score into log odds."""

    weights: np.ndarray
    slope: float
    shift: float

    def log_odds(self, text: str | None, cache: WordHashes) -> float:
        score = 0.0
        for found in buckets(text, cache):
            if len(found):
                score += float(self.weights[found].mean())
        return self.slope * score + self.shift

    def probability(self, text: str | None, cache: WordHashes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.log_odds(text, cache), -500, 500))))


def has_words(text: str | None) -> bool:
    return bool((text or "").strip(BLANKS))


def train(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: int = 1000,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 7,
) -> LinearModel | None:
    """Learn P(label = 1) from at most ``per_class`` documents of each class.

    ``per_class`` bounds what reaches the driver: sparse features of the labelled
    documents with the lowest hash of their key. A key labelled more than once
    counts with its lowest label. Class shares are counted over all labels. Null
    keys and labels are left out; None if a class has no document.
    """
    known = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
        .where(F.col("key").isNotNull() & F.col("y").isin(0, 1))
        .groupBy("key")
        .agg(F.min("y").alias("y"))
    )
    share = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(share) < 2:
        return None
    lowest = [
        known.where(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(per_class)
        for y in (0, 1)
    ]
    sample = F.broadcast(lowest[0].unionByName(lowest[1]))  # at most 2 * per_class rows
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def sparse(batches):
        cache = WordHashes()
        for batch in batches:
            rows = [features(x, cache) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([i.tobytes() for i, _ in rows], pa.binary()),
                    pa.array([v.tobytes() for _, v in rows], pa.binary()),
                ],
                names=["key", "y", "i", "v"],
            )

    found = texts.join(sample, "key").select("key", "y", "text")
    rows = found.mapInArrow(sparse, found.select("key", "y").schema.add("i", "binary").add("v", "binary"))
    # One document per key, however often its row is repeated: the bound holds.
    rows = rows.groupBy("key").agg(F.min(F.struct("y", "i", "v")).alias("r")).select("key", "r.*")
    examples = sorted(
        ((r["key"], r["y"], np.frombuffer(r["i"], np.int32), np.frombuffer(r["v"], np.float32)) for r in rows.collect()),
        key=lambda r: r[0],
    )
    if len({y for _, y, _, _ in examples}) < 2:
        return None
    return fit(examples, share, seed)


def fit(examples: list, share: dict[int, int], seed: int = 7, epochs: int = 12) -> LinearModel:
    """Adagrad on four fifths of the examples, Platt scaling on the rest.

    ``share`` holds the number of rows of each class in all labels; the
    calibrated odds are corrected from the sample's shares to these.
    """
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(examples))
    held = {y: [i for i in order if examples[i][1] == y][::5] for y in (0, 1)}
    held_out = set(held[0]) | set(held[1]) if len(examples) >= 40 else set()
    learn = [i for i in order if i not in held_out]
    weights = np.zeros(1 << BITS, np.float32)
    squares = np.full(1 << BITS, 1e-6, np.float32)
    for _ in range(epochs):
        for i in rng.permutation(learn):
            _, y, index, value = examples[i]
            gradient = (1 / (1 + np.exp(-np.clip(value @ weights[index], -30, 30))) - y) * value
            squares[index] += gradient * gradient
            weights[index] -= 0.5 * gradient / np.sqrt(squares[index])

    part = sorted(held_out) or learn
    scores = np.array([examples[i][3] @ weights[examples[i][2]] for i in part], float)
    truth = np.array([examples[i][1] for i in part], float)
    slope, shift = _platt(scores, truth)
    ones = sum(y for _, y, _, _ in examples)
    shift += np.log(share[1] / share[0]) - np.log(ones / (len(examples) - ones))
    return LinearModel(weights, float(slope), float(shift))


def _platt(scores: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with softened targets."""
    ones, zeros = truth.sum(), (1 - truth).sum()
    target = np.where(truth == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([scores, np.ones_like(scores)], 1)
    best = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ best, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-6 * best)
        best -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return best[0], best[1]
