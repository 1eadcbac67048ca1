"""I-Match fingerprints over several randomised lexicons."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hash_store import HashStore, summed_hashes, write_store
from .storage import stored
from .text import WordHashes, mix, slices, words

#: Terms in at least and at most these shares of all documents form the lexicon.
MIN_SHARE, MAX_SHARE = 1e-4, 0.1
#: Documents in a run of consecutive keys, about; runs there may be at most.
RUN_ROWS, MAX_RUNS = 1_000, 40_000
#: One fingerprint part covers the whole lexicon; then, for each of so many random
#: orders of it, a part per rate covers the subset of that share that comes first.
RATES, PER_RATE = (1 / 32, 1 / 128, 1 / 512, 1 / 2048), 10
PARTS = 1 + len(RATES) * PER_RATE
#: Hex digits of a part; a part without a term is all zeros.
DIGITS = 8


def build_lexicon(documents: DataFrame, text: str = "text", min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> HashStore:
    """The terms whose document frequency lies in the band, over all documents.

    The lower end bounds the lexicon whatever the number of documents: at most
    a document's mean number of distinct terms over ``min_share``.
    """

    def distinct():
        cache = WordHashes()
        return lambda batch: (
            cache.of(list(set(words(x)))) for x in batch.column(0).to_pylist()
        )

    rows = documents.select(F.col(text).alias("text"))
    counted = stored(summed_hashes(rows, distinct))
    total = documents.count()
    # Terms of equal hash are one term.
    within = counted.where(F.col("n").between(min_share * total, max_share * total))
    return write_store(stored(within), ["n"])


class Fingerprints:
    """Fingerprints texts in a task; remembers which words the lexicon has."""

    def __init__(self, lexicon: HashStore, most: int = 400_000):
        self.lexicon, self.most = lexicon, most
        self.cache, self.known = WordHashes(most), {}
        self.limits = np.array([int(r * 2**63) * 2 for r in RATES], np.uint64)
        self.seeds = mix(np.arange(1, PER_RATE + 1, dtype=np.uint64))

    def learn(self, found: set[bytes]) -> None:
        """Look up words of a batch of texts that were not met before."""
        if len(self.known) + len(found) > self.most:
            self.known = {}
        new = [w for w in found if w not in self.known]
        hashes = self.cache.of(new)
        order = np.argsort(hashes)
        inside = np.zeros(len(new), bool)
        inside[order] = self.lexicon.find(hashes[order]) >= 0
        self.known.update(zip(new, np.where(inside, hashes, 0).tolist(), strict=True))

    def codes(self, texts: list[set[bytes]]) -> np.ndarray:
        """A row of ``PARTS`` numbers for the distinct terms, all learnt before, of each text.

        A text with words but without a term in the lexicon takes all its words,
        so that different texts do not share an empty fingerprint. A part without a
        term is 0.
        """
        codes = np.zeros((len(texts), PARTS), np.uint32)
        values = []
        for terms in texts:
            own = np.fromiter(map(self.known.__getitem__, terms), np.uint64, len(terms))
            own = own[own > 0]
            values.append(own if len(own) or not terms else self.cache.of(list(terms)))
        text = np.repeat(np.arange(len(texts)), [len(x) for x in values])
        terms = np.concatenate([*values, np.empty(0, np.uint64)])
        codes[:, :1] = _parts(text, terms, np.array([2**64 - 1], np.uint64), len(texts))
        # Each seed orders the lexicon at random; its subsets are the first terms.
        for i, seed in enumerate(self.seeds):
            placed = mix(terms ^ seed)
            first = placed < self.limits[0]
            found = _parts(text[first], placed[first], self.limits, len(texts))
            codes[:, 1 + i * len(RATES) : 1 + (i + 1) * len(RATES)] = found
        return codes


def _parts(text: np.ndarray, terms: np.ndarray, limits: np.ndarray, texts: int) -> np.ndarray:
    """A hash of each text's terms below each limit, in ascending order; 0 without a term.

    A term counts with its place in the order, so that sums from the first one on are
    hashes of all the prefixes.
    """
    order = np.lexsort((terms, text))
    text, terms = text[order], terms[order]
    start = np.searchsorted(text, np.arange(texts + 1))
    place = np.arange(len(text)) - start[text]
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(terms ^ mix((place + 1).astype(np.uint64))))])
    parts = np.zeros((texts, len(limits)), np.uint32)
    for i, limit in enumerate(limits):
        count = np.bincount(text[terms < limit], minlength=texts)
        hashes = mix(upto[start[:-1] + count] - upto[start[:-1]])
        hashes = hashes % np.uint64(2 ** (4 * DIGITS) - 1) + np.uint64(1)
        parts[:, i] = np.where(count > 0, hashes, 0)
    return parts


def _written(codes: np.ndarray) -> list[str]:
    """Parts in hexadecimal digits, one after the other."""
    return [row.tobytes().hex() for row in codes.astype(">u4")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal parts among those that have a term in either fingerprint, row by
    row; 1 for equal fingerprints."""
    filled = (a != 0) | (b != 0)
    alike = ((a == b) & filled).sum(1) / np.maximum(filled.sum(1), 1)
    return np.where((a == b).all(1), 1.0, alike)


def fingerprint_texts(documents: DataFrame, lexicon: HashStore, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint)`` of every text. A null text is empty: all zeros."""

    def run(batches):
        prints = Fingerprints(lexicon)
        for batch in slices(batches):
            found = _written(_all(prints, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string())], names=["key", "fingerprint"]
            )

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["key"], T.StructField("fingerprint", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _all(prints: Fingerprints, texts: list) -> np.ndarray:
    found = [np.zeros((0, PARTS), np.uint32)]
    for first in range(0, len(texts), 256):
        part = [set(words(x)) for x in texts[first : first + 256]]
        prints.learn(set().union(*part))
        found.append(prints.codes(part))
    return np.concatenate(found)


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(
    documents: DataFrame, lexicon: HashStore, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprint every text, its edited text, and compare with the next text.

    Returns ``(key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``. The next document is that with the next key in
    ascending order, the first one after the last; null keys come first, rows
    with equal keys in the order of their texts' hashes. A null text is empty.

    Keys alone are sorted first, to find the bounds of even runs of keys. Texts
    are then shuffled once, to their run; the first document of a run also goes
    to the run before it.
    """
    rows = documents.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    bounds = _run_starts(rows.select("key", "tie"))
    if not bounds:
        bounds = [(None, 0)]
    keys = np.array([_sortable(k) for k, _ in bounds])
    ties = np.array([t for _, t in bounds])
    first_of_all, last_run = bounds[0], len(bounds) - 1

    def place(keys_of, ties_of):
        """The run of each row: the last one that begins at or before it."""
        both = np.rec.fromarrays([keys, ties], names="k,t")
        rows_of = np.rec.fromarrays([keys_of, ties_of], names="k,t")
        return np.searchsorted(both, rows_of, "right") - 1

    def deal(batches):
        for batch in batches:
            k = np.array([_sortable(x) for x in batch.column(0).to_pylist()], np.int64)
            t = batch.column(2).to_numpy()
            run = place(k, t).clip(0)
            starts = np.array([(k[i], t[i]) == (keys[r], ties[r]) for i, r in enumerate(run)], bool)
            again = np.flatnonzero(starts)
            at = np.concatenate([np.arange(len(k)), again])
            to = np.concatenate([run, np.where(run[again] == 0, last_run, run[again] - 1)])
            border = np.concatenate([np.zeros(len(k), bool), np.ones(len(again), bool)])
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(to.astype(np.int64)), pa.array(border)],
                names=["key", "text", "tie", "run", "border"],
            )

    def compare(batches):
        prints = Fingerprints(lexicon)
        last = None  # run and row that waits for the next one
        for batch in slices(batches):
            columns = (batch.column(i).to_pylist() for i in range(5))
            ready = []
            for k, text_, _, run, border in zip(*columns, strict=True):
                if last is not None and last[0] == run:
                    ready.append((*last[1:], text_))
                last = None if border else (run, k, text_)
            for first in range(0, len(ready), 256):
                yield _compared(prints, ready[first : first + 256])

    schema = "key bigint, text string, tie bigint, run bigint, border boolean"
    dealt = rows.mapInArrow(deal, schema)
    # Several runs to a task, so that tasks are even though runs are dealt by hash.
    dealt = dealt.repartition(-(-len(bounds) // 4), "run").sortWithinPartitions(
        "run", "border", "key", "tie"
    )
    result = (
        "key bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return dealt.mapInArrow(compare, result).withColumnRenamed("key", key)


def _sortable(key) -> int:
    return -(2**63) if key is None else key


def _compared(prints: Fingerprints, rows: list[tuple]) -> pa.RecordBatch:
    """Rows ``(key, text, next text)``; of a run of rows only the last next text
    is not itself a row's text, so fingerprints are shared."""
    changed = [edited(a, b) for _, a, b in rows]
    texts = {x: i for i, x in enumerate(dict.fromkeys([x for _, a, b in rows for x in (a, b)] + changed))}
    codes = _all(prints, list(texts))
    own, new, following = (
        codes[[texts[x] for x in column]]
        for column in ([a for _, a, _ in rows], changed, [b for _, _, b in rows])
    )
    columns = [
        [k for k, _, _ in rows],
        [len(a) for _, a, _ in rows],
        [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed],
        _written(own),
        _written(new),
        likeness(own, new),
        likeness(own, following),
    ]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _run_starts(keys: DataFrame) -> list[tuple]:
    """The first row ``(key, tie)`` of even runs of the sorted rows, in order.

    About ``RUN_ROWS`` documents are a run; a table of more than ``MAX_RUNS`` such
    runs has longer ones, which bounds what the driver holds. A task streams
    through its runs, so their length is not held in memory.
    """
    runs = min(MAX_RUNS, max(1, -(-keys.count() // RUN_ROWS)))
    spread = keys.repartitionByRange(runs, "key", "tie").withColumn("part", F.spark_partition_id())
    starts = spread.groupBy("part").agg(F.min(F.struct("key", "tie")).alias("s"))
    return [(r["s"]["key"], r["s"]["tie"]) for r in starts.orderBy("s").collect()]
