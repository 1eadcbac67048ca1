"""Sets of hashes in files that workers map to memory."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .storage import map_array, mounted_folder, save_array
from .text import slices

#: Members per file, about.
FILE_MEMBERS = 4_000_000


class SetStore:
    """Members of sets by their file and place, as ascending unsigned hashes."""

    def __init__(self, folder: str):
        self.folder = folder
        self._open: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def get(self, file: int, place: int) -> np.ndarray:
        if file not in self._open:
            self._open[file] = [map_array(self.folder, f"{kind}-{file}") for kind in ("end", "member")]
        ends, members = self._open[file]
        return members[int(ends[place - 1]) if place else 0 : int(ends[place])]


def write_sets(sets: DataFrame, file_members: int = FILE_MEMBERS) -> tuple[SetStore, DataFrame]:
    """Write the ``members`` of a table; return the store and the table with ``file``
    and ``place`` instead of them, which has to be stored before it is read.

    Tasks write what they read, so no set is shuffled. Every attempt of a task writes
    files of its own, and its rows name them.
    """
    folder = mounted_folder(sets.sparkSession)
    kept = [c for c in sets.columns if c != "members"]
    at = sets.columns.index("members")
    places = [sets.columns.index(c) for c in kept]
    names = [*kept, "file", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            file = uuid.uuid4().int >> 65
            lists = rows.column(at)
            save_array(folder, f"end-{file}", np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64))
            save_array(folder, f"member-{file}", lists.flatten().to_numpy().view(np.uint64))
            return pa.RecordBatch.from_arrays(
                [
                    *(rows.column(i) for i in places),
                    pa.array(np.full(rows.num_rows, file, np.int64)),
                    pa.array(np.arange(rows.num_rows)),
                ],
                names=names,
            )

        for batch in slices(batches):
            held.append(batch)
            size += len(batch.column(at).flatten())
            if size >= file_members:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    schema = sets.select(*kept).schema
    for name in ("file", "place"):
        schema = schema.add(name, "long")
    return SetStore(folder), sets.mapInArrow(run, schema)
