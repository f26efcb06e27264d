"""Intermediate tables and their owner."""

import os

import pytest
from frames import rows
from pyspark.sql import functions as F

from driftlens import runtime
from driftlens.streaming import incremental


def test_a_scope_deletes_its_tables(spark):
    with runtime.scope(spark):
        kept = runtime.durable(spark.range(3), "t")
        folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://").removeprefix("file:"))
        assert kept.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="checkpoint"):
        runtime.shared_dir(Cluster)


def test_a_batch_writes_its_own_rows_only_and_compacting_keeps_the_store(spark, tmp_path):
    store, source, schema = f"{tmp_path}/store", f"{tmp_path}/in", "symbol_key string, ord long, sha256 array<string>, file_version string, machine string"
    assert incremental.read_store(spark, store) is None
    days = [[("a", 1, ["x"], "1.0", "m1"), ("b", 1, ["y"], "1.0", "m1")], [("a", 1, ["w", "x"], "", "m2")]]
    for day in days:
        spark.createDataFrame(day, schema).coalesce(1).write.mode("append").parquet(source)
        incremental.merge_available(spark.readStream.schema(schema).parquet(source), store, f"{tmp_path}/check")
    want = [("a", "w,x", "1.0", "m2"), ("b", "y", "1.0", "m1")]
    shown = lambda: rows(incremental.read_store(spark, store).withColumn("sha256", F.array_join("sha256", ",")), "symbol_key", "sha256", "file_version", "machine")
    assert shown() == want and rows(incremental.read_deltas(spark, store).groupBy("batch").count(), "batch", "count") == [(0, 2), (1, 1)]
    incremental.compact(spark, store)
    assert shown() == want and incremental.read_deltas(spark, store).count() == 2


STORE = "symbol_key string, ord long, sha256 array<string>, file_version string"


def deliver(spark, tmp_path, *days):
    store, source = f"{tmp_path}/store", f"{tmp_path}/in"
    for day in days:
        spark.createDataFrame(day, STORE).coalesce(1).write.mode("append").parquet(source)
        incremental.merge_available(spark.readStream.schema(STORE).parquet(source), store, f"{tmp_path}/check")
    return store


def stored(spark, store):
    return rows(incremental.read_store(spark, store).withColumn("sha256", F.array_join("sha256", ",")), "symbol_key", "sha256", "file_version")


@pytest.mark.parametrize("step", ["write", "publish"])
def test_a_compaction_that_fails_leaves_the_store_whole(spark, tmp_path, monkeypatch, step):
    store = deliver(spark, tmp_path, [("a", 1, ["x"], "1")], [("a", 1, ["w"], "2"), ("b", 1, ["y"], "1")])
    want = [("a", "w,x", "2"), ("b", "y", "1")]

    def stop(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        if step == "write":  # half of the rows are written when a task fails
            failing = F.udf(lambda k: k if k == "a" else 1 // 0)
            was = incremental.fold
            broken.setattr(incremental, "fold", lambda *args: was(*args).withColumn("symbol_key", failing("symbol_key")))
        else:
            broken.setattr(runtime.Folder, "publish", stop)
        with pytest.raises(Exception):  # noqa: B017
            incremental.compact(spark, store)
    assert stored(spark, store) == want and incremental.read_deltas(spark, store).count() == 3
    incremental.compact(spark, store)
    assert stored(spark, store) == want and incremental.read_deltas(spark, store).count() == 2
    incremental.vacuum(spark, store)
    assert stored(spark, store) == want and len(os.listdir(f"{store}/folded")) == 1 and not [n for n in os.listdir(f"{store}/deltas") if not n.startswith(".")]


def test_batches_after_a_compaction_count_and_unfinished_ones_do_not(spark, tmp_path):
    store = deliver(spark, tmp_path, [("a", 1, ["x"], "1")])
    incremental.compact(spark, store)
    incremental.compact(spark, store)  # nothing new: nothing to do
    assert len(os.listdir(f"{store}/folded")) == 1
    deliver(spark, tmp_path, [("a", 1, ["z"], ""), ("c", 1, ["q"], "3")])
    assert stored(spark, store) == [("a", "x,z", "1"), ("c", "q", "3")]
    os.remove(f"{store}/deltas/batch=1/_SUCCESS")
    assert stored(spark, store) == [("a", "x", "1")]


def test_a_manifest_is_never_replaced(spark, tmp_path):
    folder = runtime.Folder(spark, str(tmp_path))
    folder.publish("one", "first")
    with pytest.raises(FileExistsError):
        folder.publish("one", "second")
    assert folder.text("one") == "first" and [n for n in folder.names() if not n.startswith(".")] == ["one"]
