"""Rows that were seen before, found by digests of whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter per row of the new table, and bits it may have at most (64 MB, in
#: buckets of 32768 bits, which are broadcast). Beyond that it is left out.
BITS_PER_ROW, MOST_BITS = 32, 2**29
#: Known rows for each row of the new table from which the filter costs less than it saves.
KNOWN_PER_ROW = 4

DIGEST = "row_digest"
_BUCKET = 32_768


def row_digest(columns: Sequence[tuple[str, str]]) -> Column:
    """SHA-256 of a row's cells, given names and types as in ``DataFrame.dtypes``.

    Rows that de-duplication takes for equal have equal digests: null equals null, NaN
    equals NaN, 0.0 equals -0.0. Null differs from every value.
    """
    cells = []
    for name, kind in columns:
        cell = F.col(f"`{name}`")
        if kind in ("double", "float"):
            cell = F.when(cell == 0, F.lit(0.0).cast(kind)).otherwise(cell)
        cells.append(cell.alias(name))
    return F.sha2(F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}), 256)


def digests(df: DataFrame) -> DataFrame:
    """The digest of every different row."""
    return df.select(row_digest(df.dtypes).alias(DIGEST)).distinct()


def with_digests(df: DataFrame) -> DataFrame:
    """A column of digests, as the 32 bytes that they stand for: half of what text takes."""
    return df.withColumn(DIGEST, F.unhex(row_digest(df.dtypes)))


def digest_text(name: str = DIGEST) -> Column:
    """The digests of :func:`with_digests` as :func:`digests` has them."""
    return F.lower(F.hex(name)).alias(DIGEST)


def _position(bits: int) -> Column:
    """Where a digest's bit lies in the filter, from 1."""
    return F.pmod(F.xxhash64(DIGEST), F.lit(bits)) + 1


def _filtered(known: DataFrame, new: DataFrame, bits: int) -> DataFrame:
    """The known digests whose bit some new digest sets."""
    at = _position(bits)
    buckets = new.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap")
    )
    marked = known.withColumns({"in_bucket": F.bitmap_bucket_number(at), "bit": F.bitmap_bit_position(at)})
    joined = marked.join(F.broadcast(buckets), F.col("in_bucket") == F.col("bucket"))
    byte = F.substring("bitmap", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.floor(value / F.pow(F.lit(2), F.col("bit") % 8)) % 2 == 1
    return joined.where(is_set).select(DIGEST)


def drop_known_digests(
    marked: DataFrame, known: DataFrame, rows: int, known_rows: int | None = None
) -> DataFrame:
    """The rows of a table of :func:`with_digests` whose digest is not among ``known``.

    ``known`` has one column of digests as :func:`digests` makes it, ``rows`` and
    ``known_rows`` are the numbers of rows, the latter None if it is not known. Each side is
    shuffled once, by digest, and compared exactly. If ``known`` is far larger, a bitmap
    of the new digests, one bit per digest, first sorts out nearly all that cannot match; it
    takes the digests of ``marked`` once more, and its parts cost about as much as the rows'.
    """
    bits = max(_BUCKET, 1 << (BITS_PER_ROW * max(rows, 1) - 1).bit_length())
    if bits <= MOST_BITS and (known_rows is None or known_rows > KNOWN_PER_ROW * rows):
        known = _filtered(known, marked.select(digest_text()), bits)
    again = known.select(F.unhex(DIGEST).alias("digest_again"))
    return marked.join(again, F.col(DIGEST) == F.col("digest_again"), "left_anti")


def drop_known_rows(
    df: DataFrame, known: DataFrame, rows: int, known_rows: int | None = None
) -> DataFrame:
    """The rows of ``df`` whose digest is not among ``known``, see :func:`drop_known_digests`.

    Copies within ``df`` all stay or all go.
    """
    return drop_known_digests(with_digests(df), known, rows, known_rows).drop(DIGEST)
