"""Aligning the tokens of two tokenizers by the bytes they cover.

A text is tokenised as a whole by both. Where a token of either ends at the same
byte and the next token of either begins with a space, the text is cut: such
shared ends part it into windows, mostly words. A window is named by its token
ids, so its alignment is worked out once and remembered; a document is put
together from its windows.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hash_store import HashStore, write_store
from .storage import stored
from .text import mix, signed, slices

#: Texts of more characters than this are left to the slower, unlimited library.
LONG = 100_000
#: Texts aligned together, windows that a task remembers, distinct pairs it adds up.
TEXTS, WINDOWS, PAIRS = 64, 60_000, 500_000

# Fixed value: where byte-level tokenizers of this kind part a text beforehand.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for their own code, the other bytes
    follow in order from code point 256.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevelTokens:
    """Byte-level BPE of a ``tokenizers`` file. Special tokens in a text are plain text.

    If the file's merges are in the order of the ids they make and nothing but
    the usual pattern comes before them, ``tiktoken`` finds the same ids faster.
    """

    def __init__(self, path: str):
        self.path, self._exact = path, None
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        byte, vocabulary = byte_of_char(), config["model"]["vocab"]
        special = {t["content"] for t in config["added_tokens"]}
        own = {t: i for t, i in vocabulary.items() if t not in special}
        ids = [*vocabulary.values(), *(t["id"] for t in config["added_tokens"])]
        self.bytes = [b""] * (max(ids) + 1)
        for token, i in own.items():
            self.bytes[i] = bytes(byte[c] for c in token)
        self.fast = None
        # Tokens are then stretches of the text's own bytes: all of it, if lengths agree.
        self.cuts_only = _plain(config)
        if self.cuts_only:
            import tiktoken

            ranks = {self.bytes[i]: i for i in own.values()}
            self.fast = tiktoken.Encoding(
                "byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    @property
    def exact(self):
        if self._exact is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
            self._exact = Tokenizer.from_file(self.path)
            self._exact.encode_special_tokens = True
        return self._exact

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [self._ids(text) for text in texts]

    def _ids(self, text: str) -> np.ndarray:
        if self.fast and len(text) <= LONG:
            return self.fast.encode_to_numpy(text).astype(np.int64)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int64)


def _plain(config: dict) -> bool:
    """Whether nothing but pattern and merges, in the order of ids, makes the ids."""
    before, model = config["pre_tokenizer"] or {}, config["model"]
    if config["normalizer"] or before.get("type") != "ByteLevel" or model.get("type") != "BPE":
        return False
    if before.get("add_prefix_space") or not before.get("use_regex", True):
        return False
    if model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return False
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    made = [model["vocab"].get("".join(pair), -1) for pair in pairs]
    return all(a < b for a, b in pairwise([255, *made])) and len(made) + 256 == len(model["vocab"])


class PieceTokens:
    """A ``sentencepiece`` model. U+2581 is a space, ``<0xHH>`` a byte."""

    cuts_only = False  # it may change a text first

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.model.encode(text), np.int64) for text in texts]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers of ranges with these starts and lengths."""
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(first - before, count)


class Aligner:
    """Aligns batches of texts in a task; remembers windows by their token ids."""

    def __init__(self, a, b, most: int = WINDOWS):
        self.a, self.b, self.most = a, b, most
        self.lengths = [np.array([len(x) for x in t.bytes], np.int64) for t in (a, b)]
        self.marked = [np.array([x[:1] == b" " for x in t.bytes], bool) for t in (a, b)]
        # An id with each mark that may follow it: three entries per id.
        size = max(len(a.bytes), len(b.bytes))
        self.written = [f"{i}{mark}" for i in range(size) for mark in (",", "|", ";")]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.strings: list[str] = []
        self.groups, self.starts, self.links = array("q"), array("q", [0]), array("q")
        self.pairs: dict[int, int] = {}
        self.pair_ids = array("q")

    def batch(self, texts: list[str | None]) -> dict:
        """Counts, group texts and distinct linked pairs of every text."""
        rows, data = [], []
        for row, text in enumerate(texts):
            if text:
                rows.append(row)
                data.append(b" " + text.encode())
        found_a = self.a.ids([" " + texts[row] for row in rows])
        found_b = self.b.ids([texts[row] for row in rows])
        whole = [
            i
            for i, (x, y, z) in enumerate(zip(found_a, found_b, data, strict=True))
            if self._gives_back(0, x, z) and self._gives_back(1, y, z)
        ]
        n = len(texts)
        out = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
        out |= {
            "groups": [""] * n,
            "offsets": np.zeros(n + 1, np.int64),
            "pairs": np.empty(0, np.int64),
            "links": np.empty(0, np.int64),
        }
        if not whole:
            return out
        at = np.array([rows[i] for i in whole])
        out["n_a"][at] = [len(found_a[i]) for i in whole]
        out["n_b"][at] = [len(found_b[i]) for i in whole]
        a, b = (np.concatenate([f[i] for i in whole]) for f in (found_a, found_b))
        number, last = self._windows(a, b)
        row = at[np.searchsorted(np.cumsum(out["n_a"][at]), last + 1)]
        self._put_together(out, number, row)
        return out

    def _gives_back(self, side: int, ids: np.ndarray, data: bytes) -> bool:
        """Whether the tokens' bytes in a row are the text."""
        if int(self.lengths[side][ids].sum()) != len(data):
            return False
        tokens = (self.a, self.b)[side]
        if tokens.cuts_only:
            return True
        return data == b"".join(map(tokens.bytes.__getitem__, ids.tolist()))

    def _windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of every window in a row of tokens, and its last token of ``a``."""
        ends_a, ends_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        other = np.searchsorted(ends_b, ends_a)
        cut = ends_b[other] == ends_a
        cut[:-1] &= self.marked[0][a[1:]]
        follows = np.append(self.marked[1][b[1:]], True)
        last = np.flatnonzero(cut & follows[other])
        upto_a, upto_b = last + 1, other[last] + 1
        n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)

        # A key per window: the number of its first ids, then both sorts of ids.
        count = np.arange(len(last))
        keys = np.empty(len(a) + len(b) + len(last), np.uint32)
        keys[upto_a - n_a + upto_b - n_b + count] = n_a
        window = np.repeat(count, n_a)
        keys[np.arange(len(a)) + (upto_b - n_b)[window] + window + 1] = a
        window = np.repeat(count, n_b)
        keys[np.arange(len(b)) + upto_a[window] + window + 1] = b
        raw = keys.tobytes()
        bounds = (4 * (upto_a + upto_b + count + 1)).tolist()
        named = [raw[i:j] for i, j in pairwise([0, *bounds])]

        number = list(map(self.known.get, named))
        missing = [i for i, n in enumerate(number) if n is None]
        new = {named[i]: i for i in missing}
        if len(self.known) + len(new) > self.most:
            self.forget()
            missing = range(len(named))
            new = {named[i]: i for i in missing}
        if new:
            at = np.fromiter(new.values(), np.int64, len(new))
            own_a, own_b = (_ranges(u[at] - n[at], n[at]) for u, n in ((upto_a, n_a), (upto_b, n_b)))
            self._learn(new, a[own_a], b[own_b], n_a[at], n_b[at])
            for i in missing:
                number[i] = self.known[named[i]]
        return np.array(number, np.int64), last

    def _learn(self, names: Iterable[bytes], a, b, n_a, n_b) -> None:
        """Work out the alignments of windows with these tokens in a row."""
        ends_a, ends_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        window = np.repeat(np.arange(len(n_a)), n_a)
        # Every stretch between two ends lies in one token of either: a link.
        ends = np.union1d(ends_a, ends_b)
        of_a, of_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        pairs, place = np.unique(a[of_a] << 32 | b[of_b], return_inverse=True)
        for pair in pairs.tolist():
            if pair not in self.pairs:
                self.pairs[pair] = len(self.pair_ids)
                self.pair_ids.append(pair)
        numbers = np.fromiter(map(self.pairs.__getitem__, pairs.tolist()), np.int64, len(pairs))
        upto = np.cumsum(np.bincount(window[of_a])) + len(self.links)
        self.links.frombytes(numbers[place].tobytes())
        self.starts.frombytes(upto.astype(np.int64).tobytes())

        shared_a, shared_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        self.groups.frombytes(np.bincount(window[shared_a]).astype(np.int64).tobytes())
        group_a, group_b = (np.cumsum(x) - x for x in (shared_a, shared_b))
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        items = np.concatenate([3 * a + shared_a, 3 * b + 2 * shared_b])[order]
        written = list(map(self.written.__getitem__, items.tolist()))
        # A window's items end with the last token of b, whose mark is left out.
        tokens = np.cumsum(n_a + n_b)
        first = len(self.strings)
        self.strings += ["".join(written[i:j])[:-1] for i, j in pairwise([0, *tokens.tolist()])]
        self.known.update(zip(names, range(first, len(self.strings)), strict=True))

    def _put_together(self, out: dict, number: np.ndarray, row: np.ndarray) -> None:
        """Sum up the windows ``number`` of the ascending rows ``row``."""
        n = len(out["groups"])
        groups = np.frombuffer(self.groups, np.int64)
        starts, links = np.frombuffer(self.starts, np.int64), np.frombuffer(self.links, np.int64)
        size = np.diff(starts)[number]
        out["n_groups"] = np.bincount(row, groups[number], n).astype(np.int64)
        out["n_links"] = np.bincount(row, size, n).astype(np.int64)
        own, first = np.unique(row, return_index=True)
        numbers = number.tolist()
        for r, (i, j) in zip(own.tolist(), pairwise([*first.tolist(), len(numbers)]), strict=True):
            out["groups"][r] = ";".join(map(self.strings.__getitem__, numbers[i:j]))

        both = (np.repeat(row, size) << 32) + links[_ranges(starts[number], size)]
        both, times = np.unique(both, return_counts=True)
        out["pairs"] = np.frombuffer(self.pair_ids, np.int64)[both & 0xFFFFFFFF]
        out["links"] = times
        out["offsets"] = np.searchsorted(both >> 32, np.arange(n + 1))


#: Columns of :func:`aligned` besides the key.
ADDED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "pairs array<bigint>, links array<bigint>"
)


def aligned(
    documents: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Align the tokens of every whole text under two tokenizers.

    ``a`` is the path of a byte-level ``tokenizers`` file, which gets a space and
    the text, ``b`` that of a ``sentencepiece`` model, which adds the space itself.
    Returns ``(key, n_a, n_b, n_groups, n_links, groups, pairs, links)``, one row
    per input row. Byte offsets where tokens of both end cut the text into groups;
    ``groups`` lists their ids, ``a1,a2|b1;a3|b2``. A token of ``a`` and one of
    ``b`` are linked if they share a byte. ``pairs`` has every linked pair of ids
    once, as ``a << 32 | b``, ``links`` how many links each stands for.

    A null or empty text, and one that the tokens of either do not give back byte
    by byte, has no tokens: zeros, an empty string and empty arrays. Repeated rows
    and keys are rows of their own; other columns play no part.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteLevelTokens(a), PieceTokens(b))
        for batch in slices(batches, TEXTS):
            out = aligner.batch(batch.column(1).to_pylist())
            offsets = pa.array(out["offsets"], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(out[c])) for c in ("pairs", "links")]
            counts = [pa.array(out[c]) for c in ("n_a", "n_b", "n_groups", "n_links")]
            columns = [batch.column(0), *counts, pa.array(out["groups"], pa.string()), *lists]
            names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    found = rows.mapInArrow(run, f"key {kind}, {ADDED}")
    return found.withColumnRenamed("key", key)


def pair_counts(links: DataFrame, flush: int = PAIRS) -> HashStore:
    """How many links hold each pair of ids, over all rows of ``(pairs, links)``.

    A store under a hash that different pairs never share, with the numbers ``n``
    and ``best``, the highest ``n`` of any pair with the same id of ``b``. Tasks add
    up their own rows before the shuffle; a ``b`` has at most as many pairs as
    ``a`` has ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, held = np.empty(0, np.int64), np.empty(0, np.int64), []

        def merged():
            every = np.concatenate([pairs, *(x for x, _ in held)])
            weight = np.concatenate([counts, *(y for _, y in held)])
            kinds, place = np.unique(every, return_inverse=True)
            total = np.zeros(len(kinds), np.int64)
            np.add.at(total, place, weight)
            return kinds, total

        def batch_of(kinds, total):
            hashes = signed(mix(kinds.view(np.uint64)))
            columns = [pa.array(hashes), pa.array(kinds & 0xFFFFFFFF), pa.array(total)]
            return pa.RecordBatch.from_arrays(columns, names=["hash", "b", "n"])

        waiting = 0
        for batch in batches:
            held.append(tuple(batch.column(i).flatten().to_numpy() for i in (0, 1)))
            waiting += len(held[-1][0])
            if waiting >= 2 * flush:
                (pairs, counts), held, waiting = merged(), [], 0
                if len(pairs) >= flush:
                    yield batch_of(pairs, counts)
                    pairs, counts = pairs[:0], counts[:0]
        pairs, counts = merged()
        if len(pairs):
            yield batch_of(pairs, counts)

    parts = links.select("pairs", "links").mapInArrow(run, "hash bigint, b bigint, n bigint")
    counted = parts.groupBy("hash", "b").agg(F.sum("n").alias("n"))
    best = F.max("n").over(Window.partitionBy("b"))
    return write_store(stored(counted.select("hash", "n", best.alias("best"))), ["n", "best"])


def with_pair_scores(links: DataFrame, counts: HashStore) -> DataFrame:
    """Replace ``pairs`` and ``links`` by sums over a row's links.

    ``n_best`` links hold a pair that no pair of the same id of ``b`` exceeds;
    ``count_sum`` adds up the counts of the pairs of all links.
    """
    kept = [c for c in links.columns if c not in ("pairs", "links")]
    schema = links.select(*kept).schema.add("n_best", T.LongType()).add("count_sum", T.LongType())
    names = schema.fieldNames()
    places = [links.columns.index(c) for c in kept]
    pairs_at, links_at = (links.columns.index(c) for c in ("pairs", "links"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            pairs, times = (batch.column(i).flatten().to_numpy() for i in (pairs_at, links_at))
            size = batch.column(pairs_at).value_lengths().to_numpy()
            hashes, place = np.unique(mix(pairs.view(np.uint64)), return_inverse=True)
            found = counts.find(hashes)
            n, best = (counts.take(name, found)[place] for name in ("n", "best"))
            ends = np.cumsum(size)
            sums = []
            for values in (times * (n == best), times * n):
                upto = np.concatenate([[0], np.cumsum(values)])
                sums.append(pa.array(upto[ends] - upto[ends - size], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + sums, names=names)

    return links.mapInArrow(run, schema)
