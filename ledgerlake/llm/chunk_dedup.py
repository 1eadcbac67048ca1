"""Substring de-duplication by content-defined chunks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import mix, signed, slices, with_columns

#: Bytes of a chunk: at least, and at most.
MIN_CHUNK, MAX_CHUNK = 16, 1024
#: A blank ends a chunk if these bits of the rolling hash are 0: one in four,
#: decided by the last 16 bytes.
CUT_BITS, CUT_SHIFT = 2, 14
#: Once no blank has come for so many bytes, any character border ends a chunk if
#: these bits are 0: one in eight. Such a stretch has a word per ``WORD_BYTES``
#: bytes (an English word and its blank, two Chinese characters).
NO_BLANK, ANY_BITS, ANY_SHIFT, WORD_BYTES = 64, 3, 13, 6
#: Repeated chunks in a row are reported from this many words on.
MIN_WORDS = 20


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash at every byte, over the last 16 bytes.

    The hash is the sum of a random number per byte, shifted by the byte's
    distance; doubling the window sums it in four steps.
    """
    gear = (mix(np.arange(1, 257, dtype=np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
    h = gear[data]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint16(step)
    return h


def _blanks(values: np.ndarray) -> np.ndarray:
    return (values == 32) | ((values >= 9) & (values <= 13))


def blankless(blank: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of more than ``NO_BLANK`` bytes without a blank."""
    edges = np.concatenate([[-1], np.flatnonzero(blank), [len(blank)]])
    long = np.flatnonzero(np.diff(edges) > NO_BLANK + 1)
    return [(int(edges[i]) + 1, int(edges[i + 1])) for i in long]


def chunk_words(data: bytes, ends: list[int]) -> list[int]:
    """Words of each chunk: parts between blanks, and in stretches without a
    blank one per ``WORD_BYTES`` bytes."""
    stretches = blankless(_blanks(np.frombuffer(data, np.uint8)))
    counts, start, at = [], 0, 0
    for end in ends:
        n, place = 0, start
        while at < len(stretches) and stretches[at][1] <= start:
            at += 1
        i = at
        while i < len(stretches) and stretches[i][0] < end:
            low, high = max(stretches[i][0], start), min(stretches[i][1], end)
            n += len(data[place:low].split()) + max(1, (high - low) // WORD_BYTES)
            place = high
            i += 1
        counts.append(n + len(data[place:end].split()))
        start = end
    return counts


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a text's UTF-8 bytes end.

    Chunks end behind a blank that the rolling hash selects, so an insertion
    moves borders only near it. Where no blank has come for ``NO_BLANK`` bytes,
    the hash selects among all character borders instead. A chunk that would
    grow beyond ``MAX_CHUNK`` is cut at a character.
    """
    if not data:
        return []
    values = np.frombuffer(data, np.uint8)
    blank = _blanks(values)
    hashes = gear_hashes(values)
    mask = np.uint16(((1 << CUT_BITS) - 1) << CUT_SHIFT)
    chosen = blank & ((hashes & mask) == 0)
    mask = np.uint16(((1 << ANY_BITS) - 1) << ANY_SHIFT)
    for begin, end in blankless(blank):
        place = slice(begin + NO_BLANK, end - 1)
        border = (values[begin + NO_BLANK + 1 : end] & 0xC0) != 0x80
        chosen[place] = border & ((hashes[place] & mask) == 0)
    marked = np.flatnonzero(chosen) + 1
    ends, start = [], 0

    def fill(to: int) -> None:
        nonlocal start
        while to - start > MAX_CHUNK:
            end = start + MAX_CHUNK
            while data[end] & 0xC0 == 0x80:
                end -= 1
            ends.append(end)
            start = end

    for end in marked.tolist():
        if end - start >= MIN_CHUNK:
            fill(end)
            ends.append(end)
            start = end
    if start < len(data):
        fill(len(data))
        ends.append(len(data))
    return ends


def _text_id(text: str | None) -> int:
    """The ``text_id`` of :func:`chunks`."""
    name = xxhash.xxh32_intdigest((text or "").encode("utf-8", "surrogatepass"))
    return name - (name >> 31 << 32)


def chunks(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text_id, start, length, words, digest, check)``, a row per chunk.

    Offsets are UTF-8 bytes; ``digest`` and ``check`` together are 96 bits.
    ``text_id`` tells apart texts that share a key. A null or empty text has no
    chunk.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = "text_id int, start int, length int, words int, digest bigint, check int"
    names = ["key", *(c.split()[0] for c in schema.split(", "))]

    def run(batches):
        for batch in slices(batches):
            at, columns = [], [[] for _ in range(4)]
            ids, digests = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                start, name = 0, xxhash.xxh32_intdigest(data)
                ends = chunk_ends(data)
                for end, words in zip(ends, chunk_words(data, ends), strict=True):
                    part = data[start:end]
                    at.append(row)
                    ids.append(name)
                    digests.append(xxhash.xxh64_intdigest(part))
                    values = (start, end - start, words, xxhash.xxh32_intdigest(part))
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                    start = end
            made = [pa.array(c, pa.int32()) for c in columns[:3]]
            check, ids = (pa.array(np.array(c, np.uint32).view(np.int32)) for c in (columns[3], ids))
            keys = batch.column(0).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [keys, ids, *made, pa.array(signed(digests)), check], names=names
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {schema}")


def repeated_chunks(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All chunks that occur more than once, with where they occur first.

    Adds ``copies``, ``first_key``, ``first_start`` and ``kept`` to the columns of
    :func:`chunks`; ``kept`` marks the first occurrence, by key (null first),
    text and offset. Occurrences are counted in the tasks that cut the chunks,
    and only digests that repeat are joined back, so a chunk that very many
    documents share is never gathered.
    """
    found = chunks(documents, key, text)
    place = F.struct("key", "text_id", "start")
    several = (
        found.groupBy(F.col("digest").alias("of_digest"), F.col("check").alias("of_check"))
        .agg(F.count("*").alias("copies"), F.min(place).alias("at"))
        .where("copies > 1")
    )
    same = (F.col("digest") == F.col("of_digest")) & (F.col("check") == F.col("of_check"))
    return found.join(several, same).select(
        *found.columns,
        "copies",
        F.col("at.key").alias("first_key"),
        F.col("at.start").alias("first_start"),
        (place == F.col("at")).alias("kept"),
    )


def repeated_passages(
    documents: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Runs of repeated chunks with at least ``min_words`` words.

    Words are counted as in :func:`chunk_words`, also for text without blanks.

    Returns ``(key, start, length, words, copies, first_key, first_start, kept)``:
    byte offset and length in the text, the most copies one of the chunks has,
    and the place of the first chunk's first occurrence. A run ends where a
    chunk is unique, and where first occurrences and later copies meet. A
    passage is found by the whole chunks inside it, so up to a chunk is missing
    at either end. Rows repeated with equal key and text are one document here,
    whose chunks count as copies.
    """
    return _passages(documents, key, text, min_words).drop("text_id").withColumnRenamed("key", key)


def _passages(documents: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """:func:`repeated_passages`, with ``key`` and ``text_id`` in front."""
    rows = repeated_chunks(documents, key, text).dropDuplicates(["key", "text_id", "start"])
    order = Window.partitionBy("key", "text_id").orderBy("start")
    goes_on = (F.lag(F.col("start") + F.col("length")).over(order) == F.col("start")) & (
        F.lag("kept").over(order) == F.col("kept")
    )
    begins = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    rows = rows.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order))
    runs = rows.groupBy("key", "text_id", "run").agg(
        F.min("start").alias("start"),
        F.sum("length").alias("length"),
        F.sum("words").alias("words"),
        F.max("copies").alias("copies"),
        F.min(F.struct("start", "first_key", "first_start")).alias("head"),
        F.first("kept").alias("kept"),
    )
    return runs.where(F.col("words") >= min_words).select(
        "key",
        "text_id",
        "start",
        "length",
        "words",
        "copies",
        F.col("head.first_key").alias("first_key"),
        F.col("head.first_start").alias("first_start"),
        "kept",
    )


def drop_repeated_passages(
    documents: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Cut later copies of repeated passages out of the texts.

    Has the columns of ``documents``. A null key's texts are left as they are;
    texts that share a key are cut each by its own passages.
    """
    runs = _passages(documents, key, text, min_words).where("not kept")
    spans = runs.groupBy(F.col("key").alias("_ll_cut_key"), F.col("text_id").alias("_ll_cut_text")).agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_ll_cut_spans")
    )

    def make():
        return lambda texts: [[_text_id(x) for x in texts]]

    added = T.StructType([T.StructField("_ll_text_id", T.IntegerType())])
    named = with_columns(documents, text, make, added)
    same = (F.col(key) == F.col("_ll_cut_key")) & (F.col("_ll_text_id") == F.col("_ll_cut_text"))
    joined = named.join(spans, same, "left")
    data = F.col(text).cast("binary")
    size = F.octet_length(text)
    edges = F.transform(
        F.sequence(F.lit(0), F.size("_ll_cut_spans")),
        lambda i: F.struct(
            F.when(i == 0, 0)
            .otherwise(F.get("_ll_cut_spans", i - 1)["start"] + F.get("_ll_cut_spans", i - 1)["length"])
            .alias("begin"),
            F.coalesce(F.get("_ll_cut_spans", i)["start"], size).alias("end"),
        ),
    )
    parts = F.transform(
        edges,
        lambda e: F.substring(data, (e["begin"] + 1).cast("int"), (e["end"] - e["begin"]).cast("int")).cast("string"),
    )
    cleaned = F.when(F.col("_ll_cut_spans").isNull(), F.col(text)).otherwise(F.array_join(parts, ""))
    return joined.select(*(cleaned.alias(c) if c == text else F.col(c) for c in documents.columns))
