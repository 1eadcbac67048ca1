"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from itertools import pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from .small_tables import gapless_rank
from .storage import stored
from .text import slices

CAPACITY, SEPARATOR = 2048, 0


#: The border between a letter or digit, of ASCII or Latin-1, and an ASCII sign behind it
#: other than an apostrophe. What is rarer is looked for first.
_BORDER = re.compile(
    rb"(?=[!-&(-/:-@[-`{-~])(?:(?<=[0-9A-Za-z])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))"
)
# Texts on which a tokenizer is tried.
_PROBES = (
    "Ab cD",
    "word. Word, WORD! 3.14; a:b? x...",
    "it's IT'S don't, we'll.",
    "\tA\n\nb \r\x0b\x0c c  d ",
    "Élan, STRASSE. 12.5% (x), 日本. e\u0301.",
    "thé$$$ a### x=y é=\u0338 a<\u0338b c`d_e ×. ÷. @f",
    "<|endoftext|> A.",
)


class TokenIds(dict):
    """Token ids of a word as little-endian bytes, remembered up to ``most`` words.

    The tokenizer sees white space as a border that no token crosses, so a
    text's ids are those of its words in a row. Likewise for the border between
    a letter or digit and punctuation behind it, and ASCII upper-case letters have
    the ids of lower-case ones; so few different words are left to encode. Those of
    letters alone are encoded many in a text, and told apart by the tokens that
    end a word; those of a to z alone by the tokenizer's model as they are, as there is
    nothing to normalize in them. A tokenizer that does otherwise on one of a few
    texts is refused.
    """

    def __init__(self, path: str, most: int = 400_000):
        super().__init__()
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.plain = Tokenizer(self.tokenizer.model)  # the same one, not a copy
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ending = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ending[i] = token.endswith("</w>")
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.lower().encode() for token in added]
        for text in _PROBES:
            words = self.words(text.encode())
            self.learn([words])
            (whole,) = self._ids([text])
            if self.of(words) != whole.tobytes():
                raise ValueError(f"{path}: the tokenizer does not encode texts word by word")

    def apart(self, text: bytes) -> bytes:
        """A text in lower case, with a space between words and punctuation behind them."""
        lower = text.lower()
        if any(token in lower for token in self.special):
            return text  # only its own case makes it a special token
        # Before a combining mark case can matter too: both compose into other letters.
        if b"\xcc" not in text and b"\xcd" not in text:
            text = lower
        return _BORDER.sub(b" ", text)

    def words(self, text: bytes) -> list[bytes]:
        """A text's words in lower case, punctuation behind them apart."""
        return self.apart(text).split()

    def learn(self, texts: list[list[bytes]]) -> None:
        """Encode the words of these texts that are not known yet."""
        self._learn(set().union(*texts))

    def _learn(self, found) -> None:
        if len(self) + len(found) > self.most:
            self.clear()
        self._encode([word for word in found if word not in self])

    def of_texts(self, texts: list[bytes | None], end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, ``end`` after each, and where each text begins;
        the last border is the end. Every different word is looked up once."""
        rows = pa.array([self.apart(x or b"") for x in texts], pa.large_binary())
        # The view takes bytes that are no UTF-8 as they are; only ASCII matters here.
        split = pc.ascii_split_whitespace(rows.view(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        different = coded.dictionary.view(pa.large_binary()).to_pylist()
        self._learn(different)
        found = [self[word] for word in different]
        found.append(end)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(sizes) - sizes
        last = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)
        words = np.insert(coded.indices.to_numpy(), last, len(different))
        number = sizes[words]
        behind = np.cumsum(number)
        place = np.repeat(first[words] - behind + number, number)
        place += np.arange(len(place))
        ids = np.frombuffer(b"".join(found), "<u4")[place]
        return ids, np.concatenate([[0], behind[last + np.arange(len(last))]])

    def of(self, words: list[bytes]) -> bytes:
        """The ids of words that are known."""
        if len(words) < 2:
            return b"".join(self[word] for word in words)
        return b"".join(itemgetter(*words)(self))

    def _encode(self, need: list[bytes]) -> None:
        plain, other, single = [], [], []
        for word in need:
            if word.isalpha() and word.islower():  # in bytes, a to z alone
                plain.append(word)
            else:
                (other if word.decode("utf-8", "replace").isalpha() else single).append(word)
        single += self._together(plain, self.plain)
        single += self._together(other, self.tokenizer)
        texts = [word.decode("utf-8", "replace") for word in single]
        for word, ids in zip(single, self._ids(texts), strict=True):
            self[word] = ids.tobytes()

    def _together(self, need: list[bytes], by: Tokenizer) -> list[bytes]:
        """Encode words of letters many in a text; return those that could not be told apart."""
        groups = [need[i : i + 512] for i in range(0, len(need), 512)]
        left = []
        joined = [b" ".join(group).decode("utf-8", "replace") for group in groups]
        for group, ids in zip(groups, self._ids(joined, by), strict=True):
            ends = np.flatnonzero(self.ending[ids]) + 1
            if len(ends) != len(group) or ends[-1] != len(ids):
                left += group
                continue
            data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.update(zip(group, [data[a:b] for a, b in pairwise(cuts)], strict=True))
        return left

    def _ids(self, texts: list[str], by: Tokenizer | None = None):
        for i in range(0, len(texts), 128):
            for e in (by or self.tokenizer).encode_batch_fast(texts[i : i + 128], add_special_tokens=False):
                yield np.array(e.ids, "<u4")


def token_pieces(
    documents: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    ids: bool = False,
) -> DataFrame:
    """``(key, piece, start, length, ids_crc32)`` of every document.

    A document is its token ids and one separator; only a document longer than
    ``capacity`` is cut, into pieces of that length and a rest. ``start`` counts
    the document's ids before the piece, ``ids_crc32`` is taken over the ids as
    little-endian 32-bit numbers. ``ids=True`` adds the ids themselves. A null
    text is empty: one piece with the separator alone.
    """
    end = np.array([SEPARATOR], "<u4").tobytes()
    names = ["piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        known = TokenIds(tokenizer)
        for batch in slices(batches):
            all_ids, borders = known.of_texts(batch.column(1).cast(pa.binary()).to_pylist(), end)
            at, columns = [], [[] for _ in names]
            for row, (first, last) in enumerate(pairwise(borders.tolist())):
                for piece, i in enumerate(range(first, last, capacity)):
                    own = all_ids[i : min(i + capacity, last)]
                    at.append(row)
                    values = [piece, i - first, len(own), zlib.crc32(own)]
                    if ids:
                        values.append(own.astype(np.int32))
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
            keys = batch.column(0).take(pa.array(at, pa.int32()))
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([keys, *made], names=["key", *names])

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = rows.select("key").schema
    spark_kinds = (T.IntegerType(), T.LongType(), T.LongType(), T.LongType(), T.ArrayType(T.IntegerType()))
    for name, kind in zip(names, spark_kinds, strict=False):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best-fit decreasing over the number of pieces of each length.

    Returns slots ``(length, first_rank, ranks, first_sequence, offset)``: the
    pieces of this length with ranks from ``first_rank`` on take one sequence
    each, from ``first_sequence`` on, all at ``offset``. Sequences with equal
    room are handled together, so the work depends on the number of lengths and
    not on that of the pieces.
    """
    slots: list[tuple[int, ...]] = []
    rooms: list[int] = []  # ascending
    runs: dict[int, list[tuple[int, int]]] = {}  # sequences with this room: first, number
    sequences = 0

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in runs:
                insort(rooms, room)
                runs[room] = []
            if runs[room] and sum(runs[room][-1]) == first:  # goes on where the last run ends
                runs[room][-1] = (runs[room][-1][0], runs[room][-1][1] + number)
            else:
                runs[room].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                room, first = capacity, sequences
                number = -(-left // (capacity // length))
                sequences += number
            # Each sequence takes as many as fit before the next one is begun.
            each = room // length
            full = min(number, left // each)
            for i in range(each):
                if full:
                    slots.append((length, rank, full, first, capacity - room + i * length))
                    rank += full
            left -= full * each
            put(room - each * length, first, full)
            if full < number:
                for i in range(left if left < each else 0):
                    slots.append((length, rank, 1, first + full, capacity - room + i * length))
                    rank += 1
                rest = left if left < each else 0
                left -= rest
                if rest:
                    put(room - rest * length, first + full, 1)
                put(room, first + full + bool(rest), number - full - bool(rest))
    return slots


def pack(
    pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces ``(key, piece, length, ...)``.

    The histogram has at most ``capacity`` rows; the plan made from it is a
    table of slots, whose size depends on ``capacity`` alone. Pieces are ranked
    within their length and joined to the slot that covers their rank. Lengths
    must lie between 1 and ``capacity``.
    """
    spark: SparkSession = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = spark.createDataFrame(
        plan_best_fit(counts, capacity),
        "of_length bigint, first_rank bigint, ranks bigint, first_sequence bigint, offset bigint",
    )
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    ranked = gapless_rank(pieces.select(*names), "length", [key, "piece", "start"], "rank_in_length")
    taken = (
        (F.col("length") == F.col("of_length"))
        & (F.col("rank_in_length") >= F.col("first_rank"))
        & (F.col("rank_in_length") < F.col("first_rank") + F.col("ranks"))
    )
    sequence = F.col("first_sequence") + F.col("rank_in_length") - F.col("first_rank")
    return ranked.join(F.broadcast(slots), taken).select(
        *names, sequence.alias("sequence_id"), "offset"
    )


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Tokenize documents and pack the pieces into as few sequences as best-fit
    decreasing finds.

    Returns ``(key, piece, start, length, ids_crc32, sequence_id, offset)``, a row
    per piece; offsets in a sequence follow each other from 0 without gaps. An
    empty table gives no rows. Rows that repeat, also with null keys, are pieces
    of their own. Tokens are counted once: the thin table of pieces is stored.
    """
    return pack(stored(token_pieces(documents, tokenizer, key, text, capacity), texts=True), key, capacity)
