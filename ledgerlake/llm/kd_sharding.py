"""Sharding by a k-d tree: halves of equal weight along the widest dimension.

Written with DataFrame operations alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .small_tables import gapless_rank, small
from .storage import stored

#: A coordinate has 30 bits of value and 30 bits that break ties; a weighted
#: median is found digit by digit.
VALUE_BITS, DIGIT_BITS, DIGITS = 30, 15, 4


def kd_leaves(
    points: DataFrame, weight: str, dimensions: Sequence[str], shards: int, name: Sequence[str]
) -> DataFrame:
    """Add an int column ``shard`` (0 to ``shards`` - 1) to stored points.

    ``dimensions`` are numeric columns; a null lies below all values. ``name``
    identifies a point and breaks ties. A node with several shards is cut along
    the dimension in which its points spread most, relative to the whole table,
    at the weighted quantile that gives each side its share of shards. All nodes
    of a level are cut together. What is aggregated per level is a row per node
    and dimension, and a row per node and digit; no node's points meet in a task.
    """
    ends = points.agg(
        *(f(d).alias(f"{e}{i}") for i, d in enumerate(dimensions) for f, e in ((F.min, "l"), (F.max, "h")))
    ).first()
    at = []
    for i, d in enumerate(dimensions):
        low, high = ends[f"l{i}"], ends[f"h{i}"]
        span = float(high - low) if low is not None and high > low else 1.0
        value = (F.col(d).cast("double") - F.lit(float(low or 0))) / F.lit(span)
        value = F.floor(F.coalesce(value, F.lit(0.0)) * (2**VALUE_BITS - 1)).cast("long")
        tie = F.xxhash64(F.lit(i), *name).bitwiseAND(F.lit(2**VALUE_BITS - 1))
        at.append((F.shiftleft(value, VALUE_BITS) + tie).alias(f"at{i}"))
    rows = points.select(
        *name,
        F.col(weight).alias("weight"),
        F.lit(0).alias("first"),
        F.lit(shards).alias("leaves"),
        *at,
    )
    rows = stored(rows)
    while shards > 1:
        cuts = _cuts(rows.where("leaves > 1"), len(dimensions))
        shards = -(-shards // 2)
        cut = cuts.select(
            F.col("first").alias("of_first"), F.col("leaves").alias("of_leaves"), "widest", "cut"
        )
        joined = rows.join(
            small(cut),
            (F.col("first") == F.col("of_first")) & (F.col("leaves") == F.col("of_leaves")),
            "left",
        )
        half = F.floor(F.col("leaves") / 2).cast("int")
        lower = _chosen(len(dimensions)) <= F.col("cut")
        split = F.col("cut").isNotNull()
        rows = stored(
            joined.select(
                *name,
                "weight",
                F.when(split & ~lower, F.col("first") + half).otherwise(F.col("first")).alias("first"),
                F.when(split & lower, half)
                .when(split, F.col("leaves") - half)
                .otherwise(F.col("leaves"))
                .alias("leaves"),
                *(f"at{i}" for i in range(len(dimensions))),
            )
        )
    return rows.select(*name, "weight", F.col("first").alias("shard"))


def _chosen(dimensions: int) -> Column:
    """A point's coordinate in its node's widest dimension."""
    return F.element_at(F.array(*(f"at{i}" for i in range(dimensions))), F.col("widest"))


def _cuts(rows: DataFrame, dimensions: int) -> DataFrame:
    """Per node: its widest dimension, and the last coordinate of the lower side."""
    node = ("first", "leaves")
    spread = [
        F.shiftright(F.max(f"at{i}"), VALUE_BITS) - F.shiftright(F.min(f"at{i}"), VALUE_BITS)
        for i in range(dimensions)
    ]
    # Of equal spreads the first dimension wins.
    ranked = F.array_sort(F.array(*(F.struct((-s).alias("s"), F.lit(i + 1).alias("d")) for i, s in enumerate(spread))))
    share = F.floor(F.col("leaves") / 2) / F.col("leaves")
    state = rows.groupBy(*node).agg(
        ranked[0]["d"].alias("widest"), (F.sum("weight") * F.first(share)).alias("goal")
    )
    state = stored(
        state.withColumn("prefix", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long"))
        .withColumn("own", F.lit(0).cast("long"))
    )
    for digit in range(DIGITS):
        below = DIGIT_BITS * (DIGITS - 1 - digit)
        named = state.select(
            F.col("first").alias("of_first"), F.col("leaves").alias("of_leaves"), "widest", "goal", "prefix", "before"
        )
        inside = rows.join(
            small(named),
            (F.col("first") == F.col("of_first")) & (F.col("leaves") == F.col("of_leaves")),
        ).withColumn("head", F.shiftright(_chosen(dimensions), below))
        inside = inside.where(F.shiftright("head", DIGIT_BITS) == F.col("prefix"))
        sums = inside.groupBy(*node, "widest", "goal", "before", "head").agg(F.sum("weight").alias("own"))
        order = Window.partitionBy(*node).orderBy("head")
        upto = F.sum("own").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        sums = sums.withColumn("upto", F.col("before") + upto)
        # The digit in which the lower side reaches its goal.
        reached = sums.where(F.col("upto") >= F.col("goal")).groupBy(*node, "widest", "goal").agg(
            F.min(F.struct("head", (F.col("upto") - F.col("own")).alias("before"), "own")).alias("r")
        )
        state = stored(
            reached.select(*node, "widest", "goal", F.col("r.head").alias("prefix"), "r.before", "r.own")
        )
    # The point at the border goes to the side that comes nearer to its goal.
    with_border = F.abs(F.col("before") + F.col("own") - F.col("goal")) <= F.abs(F.col("before") - F.col("goal"))
    return state.withColumn(
        "cut", F.when(with_border, F.col("prefix")).otherwise(F.col("prefix") - 1)
    )


def shard_documents(
    documents: DataFrame,
    shards: int | None = None,
    target_bytes: int = 256 << 20,
    key: str = "doc_id",
    text: str = "text",
    dimensions: dict[str, Column] | None = None,
) -> DataFrame:
    """Shards of nearly equal bytes: ``(key, size, text_crc32, shard, slot)``.

    A document's size is its text's UTF-8 bytes plus 1; a null text counts as an
    empty one. Without ``shards`` there are as many as leaves of about
    ``target_bytes`` need. Equal texts form one point of the tree, so they share
    a shard; its coordinates are the least ones of its documents. A text whose
    copies weigh more than a shard makes that shard larger; the others stay
    even. ``dimensions`` default to the key, the length, and codes of source
    and language, where these columns exist. ``slot`` numbers a shard's rows
    from 0, in the order of key hashes. An empty table gives no rows. Texts are
    read once, for digests and sizes, and never shuffled.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    if dimensions is None:
        numeric = {"byte", "short", "int", "long", "bigint", "float", "double", "tinyint", "smallint"}
        dimensions = {}
        for c, kind in documents.dtypes:
            if c in (key, "n_chars") and kind in numeric:
                dimensions[c] = F.col(c)
            elif c in ("source", "lang"):
                dimensions[c] = F.crc32(F.col(c).cast("string").cast("binary"))
        dimensions = dimensions or {"length": F.length(value)}
    places = [f"d{i}" for i in range(len(dimensions))]
    rows = stored(
        documents.select(
            F.col(key).alias("key"),
            (F.octet_length(value) + 1).cast("long").alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"),
            F.xxhash64(value).alias("a"),
            F.xxhash64(F.lit(1), value).alias("b"),
            *(c.cast("double").alias(p) for p, c in zip(places, dimensions.values(), strict=True)),
        )
    )
    if shards is None:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    points = rows.groupBy("a", "b").agg(
        F.sum("size").alias("bytes"), *(F.min(p).alias(p) for p in places)
    )
    leaves = kd_leaves(stored(points), "bytes", places, shards, ["a", "b"]).drop("weight")
    dealt = stored(rows.join(leaves, ["a", "b"]).select("key", "size", "text_crc32", "shard"))
    ranked = gapless_rank(dealt, "shard", ["key", "text_crc32"], "slot")
    return ranked.withColumnRenamed("key", key).select(key, "size", "text_crc32", "shard", "slot")
