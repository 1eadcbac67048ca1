"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

The model lies in sorted arrays in a folder that all workers see: the
vocabulary's hashes with counts, and the bigrams as 64-bit keys in shards.
Workers map these files to memory and look up what a batch of texts needs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hash_store import HashStore, summed_hashes, write_store
from .storage import map_array, mounted_folder, save_array, stored
from .text import WordHashes, slices, with_columns, words

#: The hash that stands for a text's end.
END = np.uint64(1)
#: Training tokens per bigram shard; vocabulary entries per array of word types.
SHARD_TOKENS, TYPE_ROWS = 1_000_000, 1 << 18
#: Bigrams a task holds before it deals them out; tokens scored at a time.
FLUSH, BATCH_TOKENS = 1_000_000, 250_000


def text_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    """Hashes of a text's tokens: its words, then the end."""
    found = cache.of(words(text))
    found[found == END] = np.uint64(2)
    return np.append(found, END)


def _batches(texts, cache: WordHashes, most: int = BATCH_TOKENS):
    """Runs of texts: hashes of all their tokens, and each text's number of them."""
    held, sizes, total = [], [], 0
    for text in texts:
        h = text_hashes(text, cache)
        held.append(h)
        sizes.append(len(h))
        total += len(h)
        if total >= most:
            yield np.concatenate(held), np.array(sizes)
            held, sizes, total = [], [], 0
    if held:
        yield np.concatenate(held), np.array(sizes)


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Discounts for counts 1, 2, and 3 or more, from the numbers of n-grams seen
    1 to 4 times (Chen and Goodman); kept within 0 and the count."""
    n1, n2, n3, n4 = (max(float(n), 0.5) for n in counts_of_counts)
    y = n1 / (n1 + 2 * n2)
    raw = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(raw, [0.05, 0.1, 0.15], [0.95, 1.9, 2.85])


@dataclass
class BigramModel:
    """What tasks need besides the arrays: sizes, discounts, places."""

    vocabulary: HashStore
    folder: str
    shards: int
    tokens: int  # N
    documents: int
    types: int  # bigrams
    starts: list[int]  # tokens before each vocabulary shard
    low: np.ndarray  # discounts of word types
    high: np.ndarray  # discounts of bigrams
    uniform: float  # share of the lowest order left to all words and one unknown

    def positions(self, hashes: np.ndarray):
        """Of tokens: vocabulary positions (-1 unknown) and counts."""
        kinds, place = np.unique(hashes, return_inverse=True)
        at = self.vocabulary.find(kinds)
        return at[place], self.vocabulary.take("n", at)[place]

    def before(self, positions: np.ndarray) -> np.ndarray:
        """Tokens that come before these words in the vocabulary's order."""
        shard = np.searchsorted(self.vocabulary.starts, positions, "right") - 1
        return self.vocabulary.take("before_n", positions) + np.asarray(self.starts)[shard]

    def _at(self, context, context_count, share) -> np.ndarray:
        """The shard at this share of a context's run of shards."""
        known = np.minimum(context, len(self.vocabulary) - 1)
        begin = np.where(context == len(self.vocabulary), self.tokens, self.before(known))
        place = (begin + context_count * share) / (self.tokens + self.documents)
        return np.minimum((place * self.shards).astype(np.int64), self.shards - 1)

    def shard_of(self, context, context_count, word) -> np.ndarray:
        """A context owns a run of shards by its share of all tokens; the next
        word's place in that run is by hash, so a frequent context is spread."""
        return self._at(context, context_count, (word * 0x9E3779B1 % (1 << 32)) / (1 << 32))

    def array(self, name: str) -> np.ndarray:
        opened = self.__dict__.setdefault("_open", {})
        if name not in opened:
            opened[name] = map_array(self.folder, name)
        return opened[name]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_open"}

    def word_types(self, positions: np.ndarray) -> np.ndarray:
        """Different words seen before each word; 0 for unknown words."""
        found = np.zeros(len(positions))
        part = positions // TYPE_ROWS
        for p in np.unique(part[positions >= 0]).tolist():
            at = (part == p) & (positions >= 0)
            found[at] = self.array(f"types-{p}")[positions[at] - p * TYPE_ROWS]
        return found

    def log10(self, context, context_count, word) -> np.ndarray:
        """log10 P(word | context) of each pair; positions, -1 for unknown words."""
        seen_types = self.word_types(word)
        low = np.maximum(seen_types - _discount(seen_types, self.low), 0) / max(self.types, 1)
        low = low + self.uniform / (len(self.vocabulary) + 1)
        p = low.copy()
        usable = np.flatnonzero((context >= 0) & (context_count > 0))
        if not len(usable):
            return np.log10(p)
        u, n, w = context[usable], context_count[usable], word[usable]
        count = np.zeros(len(u))
        key = (u.astype(np.uint64) << np.uint64(32)) | np.maximum(w, 0).astype(np.uint64)
        shard = self.shard_of(u, n, np.maximum(w, 0))
        for s in np.unique(shard).tolist():
            at = np.flatnonzero((shard == s) & (w >= 0))
            stored_keys, stored_counts = self.array(f"keys-{s}"), self.array(f"counts-{s}")
            if not len(at) or not len(stored_keys):
                continue
            order = at[np.argsort(key[at])]
            place = np.minimum(np.searchsorted(stored_keys, key[order]), len(stored_keys) - 1)
            hit = stored_keys[place] == key[order]
            found = stored_counts[place].astype(np.int64)
            large = np.flatnonzero(hit & (found == 255))
            if len(large):
                found[large] = self.array(f"large-{s}")[
                    np.searchsorted(self.array(f"large_at-{s}"), place[large])
                ]
            count[order] = np.where(hit, found, 0)
        # A context's bigrams may lie in several shards; its sums are added up.
        kinds, one, back = np.unique(u, return_index=True, return_inverse=True)
        first, last = (self._at(kinds, n[one], share) for share in (0.0, 1.0))
        sums = np.zeros((len(kinds), 3))
        for s in range(first.min(), last.max() + 1):
            at = np.flatnonzero((first <= s) & (s <= last))
            contexts = self.array(f"context-{s}") if len(at) else at
            if not len(contexts):
                continue
            place = np.minimum(np.searchsorted(contexts, kinds[at]), len(contexts) - 1)
            hit = contexts[place] == kinds[at]
            sums[at[hit]] += self.array(f"seen-{s}")[place[hit]]
        gamma = (sums @ self.high)[back] / n
        p[usable] = np.maximum(count - _discount(count, self.high), 0) / n + gamma * low[usable]
        return np.log10(p)


def _discount(count: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], by])[np.minimum(count, 3).astype(np.int64)]


def train_bigrams(texts: DataFrame) -> BigramModel:
    """Count a model from the single string column of ``texts``.

    Three passes: tokens, bigrams, and, from the bigrams, how many different
    words each word follows. Counts are combined in the tasks that read the
    texts; bigrams are dealt to shards by the share of tokens their context has,
    so frequent contexts are spread over as many shards as they need.
    """
    column = texts.columns[0]

    def tokens():
        cache = WordHashes()
        return lambda batch: (h for h, _ in _batches(batch.column(0).to_pylist(), cache))

    counted = summed_hashes(texts.select(F.col(column)), tokens)
    vocabulary = write_store(stored(counted), ["n"])
    sizes = vocabulary.sums["n"]
    total = sum(sizes)
    end = int(vocabulary.take("n", vocabulary.find(np.array([END])))[0])
    model = BigramModel(
        vocabulary,
        mounted_folder(texts.sparkSession),
        max(1, total // SHARD_TOKENS),
        total,
        end,
        0,
        np.cumsum([0, *sizes[:-1]]).tolist(),
        discounts(np.zeros(4)),
        discounts(np.zeros(4)),
        1.0,
    )
    return _count_bigrams(texts.select(F.col(column)), model) if total else model


def _count_bigrams(texts: DataFrame, model: BigramModel) -> BigramModel:
    def pairs(batches):
        cache = WordHashes()
        keys, held = [], 0

        def dealt():
            k, c = np.unique(np.concatenate(keys), return_counts=True)
            u, w = (k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.int64)
            n = np.where(
                u == len(model.vocabulary),
                model.documents,
                model.vocabulary.take("n", np.where(u < len(model.vocabulary), u, -1)),
            )
            shard = model.shard_of(u, n, w)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(model.shards + 1))
            found = []
            for s in range(model.shards):
                part = order[cuts[s] : cuts[s + 1]]
                if len(part):
                    several = c[part] > 1
                    found.append(
                        (s, k[part[~several]].tobytes(), k[part[several]].tobytes(), c[part[several]].astype(np.uint32).tobytes())
                    )
            columns = list(zip(*found, strict=True))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)],
                names=["shard", "once", "several", "counts"],
            )

        for batch in slices(batches):
            for hashes, sizes in _batches(batch.column(0).to_pylist(), cache):
                w, _ = model.positions(hashes)
                keys.append(_pair_keys(w, sizes, len(model.vocabulary)))
                held += len(w)
                if held >= FLUSH:
                    yield dealt()
                    keys, held = [], 0
        if held:
            yield dealt()

    def merge(key, table):
        s = key[0].as_py()
        keys, counts = [], []
        for once, several, c in zip(*(table.column(x).to_pylist() for x in ("once", "several", "counts")), strict=True):
            once = np.frombuffer(once, np.uint64)
            keys += [once, np.frombuffer(several, np.uint64)]
            counts += [np.ones(len(once), np.int64), np.frombuffer(c, np.uint32).astype(np.int64)]
        k, place = np.unique(np.concatenate(keys), return_inverse=True)
        c = np.bincount(place, np.concatenate(counts)).astype(np.int64)
        large = np.flatnonzero(c >= 255)
        context = (k >> np.uint64(32)).astype(np.int64)
        own, first = np.unique(context, return_index=True)
        seen = np.stack([np.add.reduceat(np.minimum(c, 3) == i, first, dtype=np.int64) for i in (1, 2, 3)], 1)
        for name, array in (
            ("keys", k),
            ("counts", np.minimum(c, 255).astype(np.uint8)),
            ("large_at", large),
            ("large", c[large]),
            ("context", own),
            ("seen", seen.astype(np.float64)),
        ):
            save_array(model.folder, f"{name}-{s}", array)
        w, types = np.unique((k & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        part = w // TYPE_ROWS
        cuts = np.searchsorted(part, np.arange(parts + 1))
        rows = [
            (p, w[a:b].astype(np.uint32).tobytes(), types[a:b].astype(np.uint32).tobytes())
            for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
            if b > a
        ]
        # The first row also carries the counts of counts.
        n = [[int((c == i).sum()) for i in (1, 2, 3, 4)] if not i else None for i in range(len(rows))]
        part, w, t = zip(*rows, strict=True)
        return pa.table(
            {"part": pa.array(part, pa.int64()), "words": pa.array(w, pa.binary()), "types": pa.array(t, pa.binary()), "n": pa.array(n, pa.list_(pa.int64()))}
        )

    def add_types(key, table):
        part = key[0].as_py()
        types = np.zeros(min(TYPE_ROWS, len(model.vocabulary) - part * TYPE_ROWS), np.uint32)
        for w, t in zip(table.column("words").to_pylist(), table.column("types").to_pylist(), strict=True):
            types[np.frombuffer(w, np.uint32).astype(np.int64) - part * TYPE_ROWS] += np.frombuffer(t, np.uint32)
        save_array(model.folder, f"types-{part}", types)
        low = [int((types == i).sum()) for i in (1, 2, 3, 4)] + [int((types >= 3).sum())]
        high = [sum(x[i] for x in table.column("n").to_pylist() if x) for i in range(4)]
        return pa.table({"low": pa.array([low], pa.list_(pa.int64())), "high": pa.array([high], pa.list_(pa.int64())), "total": pa.array([int(types.sum(dtype=np.int64))])})

    parts = -(-len(model.vocabulary) // TYPE_ROWS)
    # Every file that a lookup may ask for exists, also if nothing falls into it.
    for s in range(model.shards):
        for name, array in (
            ("keys", np.empty(0, np.uint64)),
            ("counts", np.empty(0, np.uint8)),
            ("context", np.empty(0, np.int64)),
        ):
            save_array(model.folder, f"{name}-{s}", array)
    for p in range(parts):
        save_array(model.folder, f"types-{p}", np.zeros(min(TYPE_ROWS, len(model.vocabulary) - p * TYPE_ROWS), np.uint32))
    dealt = texts.mapInArrow(pairs, "shard int, once binary, several binary, counts binary")
    merged = dealt.groupBy("shard").applyInArrow(
        merge, "part bigint, words binary, types binary, n array<bigint>"
    )
    sums = merged.groupBy("part").applyInArrow(
        add_types, "low array<bigint>, high array<bigint>, total bigint"
    )
    rows = sums.collect()  # one per TYPE_ROWS words
    low = np.sum([r["low"] for r in rows], axis=0)
    high = np.sum([r["high"] for r in rows], axis=0)
    model.types = sum(r["total"] for r in rows)
    model.low, model.high = discounts(low[:4]), discounts(high)
    model.uniform = float(model.low @ np.array([low[0], low[1], low[4]])) / model.types
    return model


def _pair_keys(word: np.ndarray, sizes: np.ndarray, start: int) -> np.ndarray:
    """Keys of each token with the one before it; ``start`` before the first."""
    context = np.concatenate([[start], word[:-1]])
    context[np.cumsum(sizes)[:-1]] = start
    return (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)


ADDED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("perplexity", T.DoubleType()),
    ]
)


def score_texts(documents: DataFrame, model: BigramModel, text: str = "text") -> DataFrame:
    """Add the model's log10 probability of every whole text.

    ``base_score`` is that of an add-one unigram model of the same tokens. A
    null text is empty: its only token is the end. Repeated rows score alike;
    columns named like an added one are replaced. With nothing to learn from,
    every word is as likely as the one unknown word.
    """

    def make():
        cache = WordHashes()

        def compute(texts):
            columns = [[] for _ in range(6)]
            size = len(model.vocabulary)
            for hashes, sizes in _batches(texts, cache):
                w, n = model.positions(hashes)
                base = np.log10((n + 1) / (model.tokens + size + 1))
                context = np.concatenate([[size], w[:-1]])
                begins = np.cumsum(sizes) - sizes
                context[begins] = size
                context_n = np.concatenate([[0], n[:-1]])
                context_n[begins] = model.documents
                own = model.log10(context, context_n, w)
                score = np.add.reduceat(own, begins)
                for column, values in zip(
                    columns,
                    (
                        sizes,
                        np.add.reduceat((n > 0).astype(np.int64), begins),
                        np.full(len(sizes), model.tokens),
                        np.add.reduceat(base, begins),
                        score,
                        10 ** np.minimum(-score / sizes, 300),
                    ),
                    strict=True,
                ):
                    column.extend(values.tolist())
            return columns

        return compute

    return with_columns(documents, text, make, ADDED)


def fold(key: Column, folds: int = 7) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds
