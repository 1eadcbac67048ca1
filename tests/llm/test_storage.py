import numpy as np
import pytest

from ledgerlake.llm import storage


def test_stored_tables_and_arrays(spark):
    table = storage.stored(spark.range(5))
    assert sorted(r["id"] for r in table.collect()) == [0, 1, 2, 3, 4]
    assert storage.stored(spark.range(0)).count() == 0
    folder = storage.mounted_folder(spark)
    for array in (np.arange(9, dtype=np.uint64), np.empty(0)):
        storage.save_array(folder, "a", array)
        assert storage.map_array(folder, "a").tolist() == array.tolist()


@pytest.mark.parametrize("before,most", [("10000", storage.TEXT_ROWS), ("100", 100), ("0", storage.TEXT_ROWS)])
def test_texts_go_to_workers_in_small_batches(spark, before, most):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["rows"])

    default = spark.conf.get(name)
    spark.conf.set(name, before)
    try:
        table = spark.range(3000).coalesce(1).mapInArrow(sizes, "rows bigint")
        rows = [r["rows"] for r in storage.stored(table, texts=True).collect()]
        assert sum(rows) == 3000 and max(rows) == most
        assert spark.conf.get(name) == before  # the caller's again
    finally:
        spark.conf.set(name, default)


def test_release(spark):
    import os

    from ledgerlake.llm.set_store import write_sets

    table = storage.stored(spark.createDataFrame([(1, [2, 3])], "set_id bigint, members array<bigint>"))
    store, placed = write_sets(table)
    placed = storage.stored(placed)
    paths = [storage.plain_path(table.stored_at), store.folder, storage.plain_path(placed.stored_at)]
    assert all(map(os.path.exists, paths))
    storage.release(spark, store, table, None)
    assert list(map(os.path.exists, paths)) == [False, False, True]


@pytest.mark.parametrize("folder", ["hdfs://host/x", "viewfs:/x", "s3a://bucket/x"])
def test_arrays_need_a_mounted_folder(spark, monkeypatch, folder):
    monkeypatch.setattr(storage, "shared_folder", lambda _: folder)
    with pytest.raises(ValueError, match="mounted"):
        storage.mounted_folder(spark)


def test_file_urls_are_paths(spark, monkeypatch, tmp_path):
    for url in (f"file://{tmp_path}/a", f"file:{tmp_path}/b", f"{tmp_path}/c"):
        monkeypatch.setattr(storage, "shared_folder", lambda _, url=url: url)
        assert storage.mounted_folder(spark) == f"{tmp_path}/{url[-1]}"
