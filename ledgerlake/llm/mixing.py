"""Mixing sources to target weights, by blocks dealt through a splitting tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .small_tables import small
from .storage import stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix per word of the input; words taken of a source per word of it.
SHARE, LIMIT = 1.5, 2
#: About so many words make a block. A source has at most so many blocks, which are
#: then larger: it sets how finely shards are dealt, not what is taken.
BLOCK_WORDS, MAX_BLOCKS = 16_384, 4_096
#: Documents of a source that a task sums up one by one, at most.
FEW = 10_000
#: Mean lengths of a source that are left to a choice of documents that fills them
#: best; the room in words, and the lengths, over which the choice is exact.
RESERVE, EXACT_ROOM, EXACT_LENGTHS = 8, 1 << 16, 500
#: About so many words of the mix lie in one partition of it.
PART_WORDS = 16_000_000


def source_targets(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Sources share ``share`` times all sizes by weight. None gets more than
    ``limit`` times its own size; what is above goes to the others by weight,
    until none is above. In closed form: with sources ordered by limit over
    weight, the first ones stop at their limit and the level of the others
    follows from what is left. The windows see one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    cap = F.lit(limit) * F.col("source_size")
    rows = totals.withColumn("weight", weight).withColumn("cap", cap)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("cap").over(before), F.lit(0)
    )
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    uncapped = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))
    rows = rows.withColumn("at", F.row_number().over(by_level))
    rows = rows.withColumn("free", F.when(uncapped.isNotNull(), F.struct("at", "level")))
    level = F.min("free").over(everything)["level"]
    target = F.least(F.coalesce(level * F.col("weight"), F.col("cap")), F.col("cap").cast("double"))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Deal exact block counts of each source to shards: ``(sources, shards)``.

    A node of the tree draws its left half's blocks from all of its own without
    replacement, so each shard holds its share of blocks and, in expectation,
    the mix of the whole.
    """
    if shards == 1:
        return quotas[:, None]
    left = shards // 2
    drawn = rng.multivariate_hypergeometric(
        quotas, int(quotas.sum()) * left // shards, method="marginals"
    )
    return np.concatenate(
        [split_quotas(drawn, left, rng), split_quotas(quotas - drawn, shards - left, rng)], axis=1
    )


def mix(
    documents: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    shards: int = 8,
    seed: int = 11,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
    few: int = FEW,
) -> DataFrame:
    """How often each document enters the mix, and to which shards it goes.

    Returns ``(key, source, size, source_size, target, copies, shards)``, one row
    per input row; ``shards`` has the output shard of every copy. A source is cut
    into blocks by a hash of the key; its target is as many whole passes over
    all blocks as fit, then blocks in a permuted order until about one is missing, then
    documents of the next ones in a permuted order (:func:`_first_that_fit`), then
    documents of all blocks left that fill what room there is (:func:`_fill`). So a source falls
    short of its target by less than the smallest document that it could still take.
    Of a source of one block, which is small, documents may be left out of the pass
    if that lets a longer one fill the rest exactly.
    Block quotas per shard come from :func:`split_quotas`; shards take disjoint runs
    of a source's permuted blocks. Everything follows from hashes and the seed, so
    reruns and retried tasks agree.

    A null source is a source, the last one. Sizes of 0 are taken as often as
    their block is. Rows of equal key, source and size share one decision, and count
    together for what fits; null keys hash alike.
    """
    sized = stored(
        documents.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"))
    )
    targets = source_targets(sized, weights, share, limit)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = targets.withColumn("passes", F.coalesce(passes, F.lit(0)).cast("long"))
    rest = F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    blocks = F.least(F.greatest(blocks, F.lit(1)), F.lit(MAX_BLOCKS)).cast("int")
    targets = stored(targets.withColumn("rest", rest).withColumn("blocks", blocks))

    named = targets.withColumnRenamed("source", "of_source")
    same_source = F.col("source").eqNullSafe(F.col("of_source"))
    block = F.pmod(F.xxhash64(F.lit(seed), "key"), F.col("blocks")).cast("int")
    dealt = sized.join(small(named), same_source).withColumn("block", block).drop("of_source")

    words = dealt.groupBy("source", "block").agg(
        F.sum("size").alias("words"),
        *(F.any_value(c).alias(c) for c in ("rest", "passes", "source_size", "blocks")),
    )
    permuted = Window.partitionBy("source").orderBy(
        F.xxhash64(F.lit(seed + 1), "source", "block"), "block"
    )
    upto = F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = words.withColumn("before", upto - F.col("words")).withColumn(
        "place", F.row_number().over(permuted) - 1
    )
    # About a block is left to single documents; those of the blocks it reaches into come first.
    spare = F.col("source_size") / F.col("blocks")
    full = (F.col("before") + F.col("words") <= F.col("rest") - spare) & (F.col("rest") > 0)
    cut = ~full & (F.col("before") < F.col("rest"))
    placed = stored(
        placed.select(
            F.col("source").alias("of_source"),
            F.col("block").alias("of_block"),
            "place",
            "passes",
            full.alias("full"),
            cut.alias("cut"),
            F.when(cut, F.col("rest") - F.col("before")).alias("room"),
        )
    )
    bounds = small(stored(_shard_bounds(placed, shards, seed)))

    rows = dealt.drop("passes", "rest").join(
        small(placed), same_source & (F.col("block") == F.col("of_block"))
    )
    rows = rows.drop("of_source", "of_block")
    order = F.xxhash64(F.lit(seed + 2), "key", "size").alias("order")
    # Documents that are not in a full block and may be taken one by one.
    loose = (F.col("passes") > 0) & (F.col("blocks") == 1)
    open_ = rows.where(~F.col("full") & (F.col("size") > 0)).select(
        "source", "key", "size", order, "cut", "room", loose.alias("loose")
    )
    taken = _one_by_one(open_, few).withColumnsRenamed(
        {"source": "of_source", "key": "of_key", "size": "of_size"}
    )
    same = same_source & F.col("key").eqNullSafe(F.col("of_key")) & (F.col("size") == F.col("of_size"))
    rows = rows.join(small(stored(taken)), same, "left").drop("of_source", "of_key", "of_size")
    rows = rows.join(bounds, same_source)

    copies = F.col("passes") + F.col("full").cast("int") + F.coalesce("more", F.lit(0))
    copies = copies.cast("int")
    # A copy's block takes its place after the blocks of the passes before it; documents
    # taken from a block beyond the last one are spread over those before it.
    turn = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1))
    within = F.when(F.col("full") | F.col("cut"), F.col("place")).otherwise(
        F.pmod("place", F.greatest("rest_blocks", F.lit(1)))
    )
    place = lambda i: F.when(i < F.col("passes"), F.col("place")).otherwise(within)
    to = F.transform(
        F.coalesce(turn, F.array().cast("array<int>")),
        lambda i: F.size(F.filter("bounds", lambda b: b <= i * F.col("n_blocks") + place(i))),
    )
    return rows.withColumn("copies", copies).select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        "copies",
        to.alias("shards"),
    )


def _one_by_one(open_: DataFrame, few: int) -> DataFrame:
    """``(source, key, size, more)`` of the documents taken once more, or less, one by one.

    ``open_`` has ``(source, key, size, order, cut, room, loose)``; the documents of a
    source's cut block know the room that the full blocks have left, those of a loose
    source may be left out. Rows of equal key and size become one of all their words.
    """
    units = open_.groupBy("source", "key", "size", "order", "cut", "loose").agg(
        F.sum("size").alias("words"), F.max("room").alias("room")
    )
    units = stored(units)
    # The first of the cut blocks knows the whole room.
    room = stored(units.where("cut").groupBy("source").agg(F.max("room").alias("room")))
    of = room.select(F.col("source").alias("of_source"), "room")
    begun = units.where("cut").drop("room").join(small(of), F.col("source").eqNullSafe(F.col("of_source")))
    first = stored(_first_that_fit(begun.drop("of_source"), few))
    spent = first.groupBy("source").agg(F.sum("words").alias("spent"))
    spent = spent.withColumnRenamed("source", "of_source")
    same = F.col("source").eqNullSafe(F.col("of_source"))
    left = room.join(spent, same, "left").select(
        F.col("source").alias("of_source"), (F.col("room") - F.coalesce("spent", F.lit(0))).alias("left")
    )
    names = ["source", "key", "size"]
    first = first.join(small(stored(left)), same).drop("of_source")
    others = units.drop("room").join(small(stored(left)), same).drop("of_source")
    # Those already taken may still be given back, for a longer one, if single.
    others = others.where(F.col("left") > 0).join(small(_named(first)), _same_row(names), "left_anti")
    others = others.withColumn("given", F.lit(False))
    given = first.where("single and left > 0").withColumn("given", F.lit(True)).withColumn("loose", F.lit(False))
    columns = [*names, "order", "words", "left", "loose", "given"]
    changes = stored(_fill(stored(others.select(*columns).unionByName(given.select(*columns)))))
    back = changes.where("given").select(*names)
    kept = first.join(small(stored(_named(back))), _same_row(names), "left_anti")
    kept = kept.select(*names, F.lit(1).alias("more"))
    return kept.unionByName(changes.where("not given").select(*names, "more"))


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.col(c).alias(f"same_{c}") for c in ("source", "key", "size")))


def _same_row(names: list[str]) -> Column:
    source, key, size = (F.col(c).eqNullSafe(F.col(f"same_{c}")) for c in names)
    return source & key & size


def _first_that_fit(units: DataFrame, few: int) -> DataFrame:
    """The units of each source that fit into its room, in the order of their hash.

    It ends ``RESERVE`` mean lengths before the room is full, so that :func:`_fill` has a
    choice. The place is found in the hash's range, 12 bits at a time: sums of 4096
    parts tell which parts fit as a whole and which one is cut, until at most ``few``
    units of a source are in the cut part; these are summed up one by one and come out
    as ``single``. So no task gets more of a source, however large a block is; units of
    one hash are one part and are not cut.
    """
    fitting, names = [], ["source", "key", "size", "order", "words"]
    # Flipping the sign bit puts signed hashes into the order of their bits.
    units = units.withColumn("place", F.col("order").bitwiseXOR(F.lit(-(2**63))))
    for level in range(5):
        most = units.groupBy("source").count().agg(F.max("count")).first()[0]
        if not most or most <= few:
            break
        digit = F.shiftrightunsigned("place", 52 - 12 * level).bitwiseAND(4095)
        units = units.withColumn("digit", digit)
        sums = units.groupBy(F.col("source").alias("of_source"), F.col("digit").alias("of_digit"))
        sums = sums.agg(F.sum("words").alias("all"), F.any_value("room").alias("of_room"))
        marks = small(stored(_prefix(sums, "of_source", ["of_digit"], "all", "of_room")))
        same = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("digit") == F.col("of_digit"))
        marked = units.join(marks, same)
        fitting.append(marked.where("fits").select(*names, F.lit(False).alias("single")))
        inside = marked.where(~F.col("fits") & (F.col("before") < F.col("room")))
        units = stored(
            inside.withColumn("room", F.col("room") - F.col("before")).select(
                "source", "key", "size", "words", "room", "place", "order"
            )
        )
    else:
        return _union(fitting)  # what is left has one hash a source
    order = [F.col("place").bitwiseXOR(F.lit(-(2**63))), "key", "size"]
    spare = F.col("room") - RESERVE * F.avg("words").over(Window.partitionBy("source"))
    last = _prefix(units.withColumn("room", spare), "source", order, "words", "room")
    return _union([*fitting, last.where("fits").select(*names, F.lit(True).alias("single"))])


def _prefix(rows: DataFrame, group: str, order: list, words: str, room: str) -> DataFrame:
    """Add ``before``, the words of the rows in front, and whether a row ``fits`` as a whole."""
    window = Window.partitionBy(group).orderBy(*order)
    upto = F.sum(words).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("before", upto - F.col(words)).withColumn(
        "fits", F.col("before") + F.col(words) <= F.col(room)
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def best_counts(lengths: list[int], counts: list[int], room: int, seed: int = 5) -> list[int]:
    """How many of each length to take so that they fill ``room`` as far as they can.

    Long ones are taken greedily while the room is above ``EXACT_ROOM``; then sums that
    can be reached are bits of a number, until the whole room can be. At most
    ``EXACT_LENGTHS`` lengths take part in that; whatever still fits is taken last.
    """
    taken, left = [0] * len(lengths), room
    long_first = sorted(range(len(lengths)), key=lambda i: -lengths[i])

    def greedy(spare: int) -> None:
        nonlocal left
        for i in long_first:
            n = max(0, min(counts[i] - taken[i], (left - spare) // lengths[i]))
            taken[i] += n
            left -= n * lengths[i]

    greedy(EXACT_ROOM)
    mask, reach = (1 << left + 1) - 1, [1]
    items = []
    order = np.random.default_rng(seed).permutation(len(lengths))[:EXACT_LENGTHS]
    for i in order.tolist():
        n = min(counts[i] - taken[i], left // lengths[i])
        step = 1
        while n > 0 and not reach[-1] >> left & 1:
            step = min(step, n)
            items.append((i, step))
            reach.append((reach[-1] | reach[-1] << step * lengths[i]) & mask)
            n, step = n - step, 2 * step
    total = reach[-1].bit_length() - 1
    for (i, step), before in zip(reversed(items), reversed(reach[:-1]), strict=True):
        if not before >> total & 1:
            taken[i] += step
            total -= step * lengths[i]
            left -= step * lengths[i]
    greedy(0)
    return taken


def exchanged(
    lengths: list[int],
    counts: list[int],
    room: int,
    own: list[int],
    loose: bool = False,
    tries: int = 64,
) -> tuple[list[int], list[int]]:
    """How many of each length to take, and how many to give back, so that the room is filled.

    ``counts`` may be taken, ``own`` given back, and if ``loose`` those not taken too. Only
    if no choice fills the room, one that is longer than what is left is taken, and
    others that make up the difference are given back.
    """
    fits = [n if w <= room else 0 for w, n in zip(lengths, counts, strict=True)]
    taken, none = best_counts(lengths, fits, room), [0] * len(lengths)
    left = room - sum(w * n for w, n in zip(lengths, taken, strict=True))
    free = [n - t for n, t in zip(counts, taken, strict=True)]
    longer = [i for i, w in enumerate(lengths) if w > left and free[i]] if left else []
    for i in longer[:tries]:
        back = [o + (f - (j == i)) * loose for j, (o, f) in enumerate(zip(own, free, strict=True))]
        back = best_counts(lengths, back, lengths[i] - left)
        if sum(w * n for w, n in zip(lengths, back, strict=True)) == lengths[i] - left:
            return [t + (j == i) for j, t in enumerate(taken)], back
    return taken, none


def _fill(units: DataFrame) -> DataFrame:
    """Units that fill a source's room ``left`` until none that remains would fit.

    ``units`` is a stored table. Those that are not ``given`` come back with ``more`` 1
    if they are taken, and -1 if one is left out of a pass for it, which only a loose
    source allows; given ones come back if they are given up. A task plans a source on
    the histogram of its lengths; see :func:`exchanged`. Of one length the first by
    hash are taken.
    """

    def plan(table: pd.DataFrame) -> pd.DataFrame:
        sums = table.pivot_table("n", "words", "given", "sum", 0).reindex(columns=[False, True], fill_value=0)
        lengths, counts, own = sums.index.tolist(), sums[False].tolist(), sums[True].tolist()
        loose = bool(table["loose"].any())
        taken, back = exchanged(lengths, counts, int(table["left"].iloc[0]), own, loose)
        # Given ones are given up first.
        first = [min(b, o) for b, o in zip(back, own, strict=True)]
        rows = []
        for w, t, b, f in zip(lengths, taken, back, first, strict=True):
            rows += [(w, False, t, b - f), (w, True, 0, f)]
        rows = pd.DataFrame(rows, columns=["words", "given", "taken", "dropped"])
        return rows.assign(source=table["source"].iloc[0])[["source", "words", "given", "taken", "dropped"]]

    lengths = units.groupBy("source", "words", "given").agg(
        F.count("*").alias("n"), F.any_value("left").alias("left"), F.any_value("loose").alias("loose")
    )
    kind = units.schema["source"].dataType.simpleString()
    planned = lengths.groupBy("source").applyInPandas(
        plan, f"source {kind}, words bigint, given boolean, taken bigint, dropped bigint"
    )
    planned = stored(
        planned.where("taken + dropped > 0").withColumnsRenamed(
            {"source": "of_source", "words": "of_words", "given": "of_given"}
        )
    )
    same = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("words") == F.col("of_words"))
    same = same & (F.col("given") == F.col("of_given"))
    place = Window.partitionBy("source", "words", "given").orderBy("order", "key", "size")
    # The bound lets tasks leave out all but the first rows before they shuffle any.
    most = planned.agg(F.max(F.col("taken") + F.col("dropped"))).first()[0] or 0
    ranked = units.join(small(planned), same).withColumn("rank", F.row_number().over(place))
    ranked = ranked.where(F.col("rank") <= most)
    more = F.when(F.col("rank") <= F.col("taken"), 1)
    more = more.when(F.col("rank") <= F.col("taken") + F.col("dropped"), -1)
    return ranked.withColumn("more", more).where("more is not null")


def _shard_bounds(placed: DataFrame, shards: int, seed: int) -> DataFrame:
    """Per source, where the runs of all shards but the last end.

    The tree needs all sources' quotas at once: one row per source.
    """
    begun = F.count_if(F.col("full") | F.col("cut"))
    quotas = placed.groupBy("of_source").agg(
        F.count("*").alias("n_blocks"),
        begun.alias("rest_blocks"),
        (F.any_value("passes") * F.count("*") + begun).alias("quota"),
    )

    def split(tables):
        rows = pd.concat(tables, ignore_index=True)
        rows = rows.sort_values("of_source", na_position="last", kind="stable")
        parts = split_quotas(
            rows["quota"].to_numpy(np.int64), shards, np.random.default_rng(seed)
        )
        ends = np.cumsum(parts, axis=1)[:, :-1]
        yield rows.assign(bounds=list(ends))[["of_source", "n_blocks", "rest_blocks", "bounds"]]

    kind = placed.schema["of_source"].dataType.simpleString()
    return quotas.coalesce(1).mapInPandas(
        split, f"of_source {kind}, n_blocks bigint, rest_blocks bigint, bounds array<bigint>"
    )


def mixed_documents(
    documents: DataFrame, size: Column, key: str = "doc_id", source: str = "source", shards: int = 64, seed: int = 11
) -> DataFrame:
    """The mix itself: each document as often as :func:`mix` takes it.

    Has the columns of ``documents``, in a random order within a shard: documents are
    sorted by a hash, and a shard is cut along it into parts of about ``PART_WORDS``
    words, each a partition, so no task sorts more however large a shard is. Rows that
    repeat with equal key, source and size share one decision.
    """
    drawn = mix(documents, size, key, source, shards, seed).select(
        F.col(key).alias("_ll_drawn_key"),
        F.col(source).alias("_ll_drawn_source"),
        F.col("size").alias("_ll_drawn_size"),
        F.col("shards").alias("_ll_drawn_shards"),
    )
    drawn = drawn.dropDuplicates(["_ll_drawn_key", "_ll_drawn_source", "_ll_drawn_size"]).where(F.size("_ll_drawn_shards") > 0)
    same = (
        F.col(key).eqNullSafe(F.col("_ll_drawn_key"))
        & F.col(source).eqNullSafe(F.col("_ll_drawn_source"))
        & (size == F.col("_ll_drawn_size"))
    )
    total = documents.agg(F.sum(size)).first()[0] or 0
    parts = max(1, int(SHARE * total / shards) // PART_WORDS)
    copies = documents.join(drawn, same).select(
        *documents.columns, F.posexplode("_ll_drawn_shards").alias("_ll_drawn_copy", "_ll_drawn_shard")
    )
    copies = copies.withColumn("_ll_drawn_order", F.xxhash64(F.lit(seed + 3), key, "_ll_drawn_copy"))
    part = F.shiftrightunsigned("_ll_drawn_order", 33) * parts / F.lit(2**31)
    copies = copies.withColumn("_ll_drawn_part", F.floor(part))
    place = ("_ll_drawn_shard", "_ll_drawn_part")
    return (
        copies.repartition(shards * parts, *place)
        .sortWithinPartitions(*place, F.shiftrightunsigned("_ll_drawn_order", 1))
        .select(*documents.columns)
    )
