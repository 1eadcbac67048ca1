"""Quality rules: counts of a text, fixed limits, and a calibrated classifier."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .linear_model import LinearModel, train
from .text import BLANKS, WordHashes, windows, with_columns, words

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Documents less likely than this to be of good quality are rejected.
MIN_PROBABILITY = 0.5
SYMBOLS = "#*$%&|<>"

ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("quality", T.DoubleType()),
    ]
)


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more."""
    keys = windows(hashes, 3)
    if len(keys) < 2:
        return 0
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(keys), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    covered = np.zeros(len(hashes), bool)
    for i in range(3):
        covered[i : i + len(keys)] |= twice
    return int(covered.sum())


def counts(text: str | None, cache: WordHashes) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, repeated words."""
    text = text or ""
    found = words(text, lower=False)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(found),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(cache.of(found)),
    )


def quality_rules(
    documents: DataFrame,
    model: LinearModel | None,
    text: str = "text",
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """Add counts and a verdict to every document.

    ``base_failed``: fewer than 50 words, or more than half of the words lie in
    repeated three-word windows. ``quality`` is the classifier's calibrated
    probability; ``kept`` needs it to be at least ``min_probability`` and the
    base rules to hold. Without a model the base rules decide alone and
    ``quality`` is null.

    A null text counts as an empty one, so it fails the base rules. Every row is
    judged by itself: repeated rows get equal verdicts. An input column named
    like an added one is replaced.
    """

    def make():
        cache = WordHashes()

        def compute(texts):
            base = [counts(x, cache) for x in texts]
            failed = [
                n < MIN_WORDS or 100 * again > MAX_REPEATED_PERCENT * n
                for n, _, _, _, again in base
            ]
            good = [model.probability(x, cache) if model else None for x in texts]
            kept = [
                not f and (p is None or p >= min_probability)
                for f, p in zip(failed, good, strict=True)
            ]
            columns = [list(c) for c in zip(*base, strict=True)] or [[]] * 5
            return [*columns, failed, kept, good]

        return compute

    return with_columns(documents, text, make, ADDED)


def train_quality(documents: DataFrame, labels: DataFrame, per_class: int = 1000):
    """The classifier of good documents; see :func:`.linear_model.train`."""
    return train(documents, labels, "quality", per_class)
