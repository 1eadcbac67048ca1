"""Words, hashes and Arrow batches: what several operators do to texts in a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A word is a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def words(text: str | None, lower: bool = True) -> list[bytes]:
    """The words of a text in UTF-8; ``lower`` changes A-Z only. Null has none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


class WordHashes(dict):
    """64-bit hash per word, remembered up to ``most`` words at a time."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive values."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for i in range(1, n):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[i : i + count]
    return mix(total)


def signed(values) -> np.ndarray:
    """Unsigned 64-bit values as Spark's bigint, bit by bit."""
    return np.asarray(values, np.uint64).view(np.int64)


def unsigned(values) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, so that a task holds few texts as Python objects."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
    pa.default_memory_pool().release_unused()


def with_columns(
    df: DataFrame, text: str, make: Callable[[], Callable], added: T.StructType
) -> DataFrame:
    """Add columns computed from a text column, batch by batch.

    ``make`` is called once per task and returns a function from a list of texts
    to a list of columns. An added column replaces one of the same name.
    """
    names = added.fieldNames()
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *added.fields])
    kinds = [_arrow_type(f.dataType) for f in added.fields]
    source = df.columns.index(text)
    places = [df.columns.index(f.name) for f in kept]
    all_names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in slices(batches):
            made = compute(batch.column(source).to_pylist())
            arrays = [pa.array(c, k) for c, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in places] + arrays, names=all_names
            )

    return df.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return simple[kind.simpleString()]
