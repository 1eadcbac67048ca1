"""Sorted hashes with numbers, in shard files that workers map to memory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import map_array, mounted_folder, save_array
from .text import slices

#: Hashes per shard file, about.
SHARD_ROWS = 500_000


class HashStore:
    """Unsigned 64-bit hashes in ascending order over ``2**bits`` shards.

    A hash's position among all is its number. ``values`` has the numbers
    stored with the hashes, by name; ``starts`` the position of each shard's
    first hash, ``sums`` each shard's sum of every name.
    """

    def __init__(self, folder: str, bits: int, starts: list[int], sums: dict[str, list[int]]):
        self.folder, self.bits, self.starts, self.sums = folder, bits, starts, sums
        self._open: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def array(self, shard: int, name: str) -> np.ndarray:
        if (shard, name) not in self._open:
            self._open[shard, name] = map_array(self.folder, f"{name}-{shard}")
        return self._open[shard, name]

    def __len__(self) -> int:
        return self.starts[-1]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of ascending hashes; -1 for those that are not stored."""
        found = np.full(len(hashes), -1, np.int64)
        for shard, part in self._parts(hashes):
            stored = self.array(shard, "hash")
            if not len(stored):
                continue
            at = np.searchsorted(stored, hashes[part])
            hit = at < len(stored)
            hit[hit] = stored[at[hit]] == hashes[part][hit]
            found[part] = np.where(hit, at + self.starts[shard], -1)
        return found

    def take(self, name: str, positions: np.ndarray) -> np.ndarray:
        """Stored numbers at these positions; 0 for -1."""
        taken = np.zeros(len(positions), np.int64)
        shards = np.searchsorted(self.starts, positions, "right") - 1
        for shard in np.unique(shards[positions >= 0]).tolist():
            part = (shards == shard) & (positions >= 0)
            taken[part] = self.array(shard, name)[positions[part] - self.starts[shard]]
        return taken

    def _parts(self, hashes: np.ndarray):
        if not self.bits:
            yield 0, slice(0, len(hashes))
            return
        top = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = np.searchsorted(top, np.arange((1 << self.bits) + 1))
        for shard in np.unique(top).tolist():
            yield shard, slice(cuts[shard], cuts[shard + 1])


def write_store(rows: DataFrame, names: list[str], shard_rows: int = SHARD_ROWS) -> HashStore:
    """Write stored rows ``(hash, *names)``, one per hash, as a :class:`HashStore`.

    ``hash`` is a bigint with the bits of the unsigned hash, ``names`` are
    bigints. Hashes are spread evenly, so their top bits deal them to shards of
    about ``shard_rows``; a task sorts and writes one shard. For every name it also
    writes ``before_<name>``, the running sum before each hash of the shard.
    Files appear whole and have the same content whenever a task is run again.
    """
    spark = rows.sparkSession
    bits = max(0, (rows.count() // shard_rows).bit_length())
    folder = mounted_folder(spark)
    shard = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long")

    def write(key, table):
        shard = key[0].as_py()
        hashes = table.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        save_array(folder, f"hash-{shard}", hashes[order])
        sums = []
        for name in names:
            values = table.column(name).to_numpy()[order]
            save_array(folder, f"{name}-{shard}", values)
            save_array(folder, f"before_{name}-{shard}", np.cumsum(values) - values)
            sums.append(int(values.sum()))
        return pa.table(
            {
                "shard": pa.array([shard]),
                "rows": pa.array([len(hashes)]),
                "sums": pa.array([sums], pa.list_(pa.int64())),
            }
        )

    sizes = dict.fromkeys(range(1 << bits), 0)
    sums = {name: [0] * (1 << bits) for name in names}
    written = rows.select(shard.alias("shard"), "hash", *names).groupBy("shard")
    for r in written.applyInArrow(write, "shard bigint, rows bigint, sums array<bigint>").collect():
        sizes[r["shard"]] = r["rows"]
        for name, value in zip(names, r["sums"], strict=True):
            sums[name][r["shard"]] = value
    for empty in (s for s, n in sizes.items() if not n):
        save_array(folder, f"hash-{empty}", np.empty(0, np.uint64))
    starts = np.cumsum([0, *(sizes[s] for s in range(1 << bits))]).tolist()
    return HashStore(folder, bits, starts, sums)


def summed_hashes(table: DataFrame, make_hashes, flush: int = 500_000) -> DataFrame:
    """``(hash, n)``: how often ``make_hashes(batch)`` yields each hash, over all rows.

    ``make_hashes()`` gives a function from an Arrow batch to arrays of hashes.
    Tasks add up their own counts before anything is shuffled.
    """

    def run(batches):
        of = make_hashes()
        keys, counts, held = [], [], 0

        def merged():
            k, place = np.unique(np.concatenate(keys), return_inverse=True)
            return k, np.bincount(place, np.concatenate(counts)).astype(np.int64)

        def batch_of(k, c):
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["hash", "n"])

        for batch in slices(batches):
            for hashes in of(batch):
                k, c = np.unique(hashes, return_counts=True)
                keys.append(k)
                counts.append(c)
                held += len(k)
                if held >= flush:
                    k, c = merged()
                    keys, counts, held = [k], [c], len(k)
                    if held >= flush // 2:
                        yield batch_of(k, c)
                        keys, counts, held = [], [], 0
        if keys:
            yield batch_of(*merged())

    found = table.mapInArrow(run, "hash bigint, n bigint")
    return found.groupBy("hash").agg(F.sum("n").alias("n"))
