"""Token files that grow by epochs, and read as a stream."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sequential import windows as plain_windows

from corpusflow.sources.token_bin import (
    EpochShard,
    TokenBinStreamWriter,
    append_tokens,
    arriving_windows,
    list_shards,
    read_tokens,
    read_windows,
    token_count,
)

SCHEMA = "doc_id BIGINT, ids ARRAY<INT>"


def add(spark, folder, docs):
    spark.createDataFrame(docs, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stored(spark, path):
    return [t for row in read_tokens(spark, path).orderBy("pos").collect() for t in row.tokens]


@pytest.mark.parametrize("stride", [8, 3])
def test_windows_arrive_once_over_restarts(spark, tmp_path, stride):
    rng = random.Random(stride)
    docs_in, files, out = (str(tmp_path / n) for n in ("in", "files", "out"))
    tokens = []
    for size in (1, 3, 20, 1, 9):
        docs = [(i, [rng.randrange(9) for _ in range(rng.choice([1, 2, 30]))]) for i in range(size)]
        add(spark, docs_in, docs)
        arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(docs_in)
        append_tokens(arriving, files, str(tmp_path / "cp1")).awaitTermination()
        tokens += [t for _, ids in docs for t in ids]
        assert stored(spark, files) == tokens and token_count(files, "uint16") == len(tokens)
        windows = arriving_windows(spark, files, 8, stride, eos_id=5, mask_after_eos=True, row_tokens=16)
        query = windows.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp2"))
        query.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).orderBy("window_id").collect()
    assert [row.window_id for row in got] == list(range(len(got)))
    assert [(row.x, row.y) for row in got] == plain_windows(tokens, 8, stride, 5)
    assert [(r.x, r.y) for r in read_windows(spark, files, 8, stride, eos_id=5, mask_after_eos=True).orderBy("window_id").collect()] == plain_windows(tokens, 8, stride, 5)


def test_an_epoch_that_is_run_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "files")
    writer = TokenBinStreamWriter({"path": path})

    def shard(task, ids):
        name = f"tokens-{task:018d}-{random.randrange(16**32):032x}.bin"
        np.array(ids, "<u2").tofile(f"{path}/{name}")
        return EpochShard(task, name, len(ids))

    writer.commit([shard(1, [3, 4]), shard(0, [1, 2]), None], 0)
    writer.commit([shard(0, [5])], 1)
    again = [shard(0, [5])]
    writer.commit(again, 1)
    writer.commit([], 2)  # an epoch without rows
    writer.abort([shard(0, [9, 9])], 3)
    assert stored(spark, path) == [1, 2, 3, 4, 5]
    left = [s.path for s in list_shards(path, "uint16")]
    assert len(left) == 3 and len(list((tmp_path / "files").glob("tokens-*"))) == 3
    with pytest.raises(ValueError, match="uint16"):
        list_shards(path, "uint32")


def test_ids_must_fit(spark, tmp_path):
    add(spark, str(tmp_path / "in"), [(1, [70_000])])
    arriving = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="do not fit"):
        append_tokens(arriving, str(tmp_path / "files"), str(tmp_path / "cp")).awaitTermination()


def test_one_table_under_two_filters(spark, tmp_path):
    np.arange(1000, dtype="<u2").tofile(tmp_path / "t.bin")
    table = read_tokens(spark, str(tmp_path / "t.bin"), row_tokens=20)
    few = table.where((F.col("pos") >= 100) & (F.col("pos") < 160))
    assert [few.count(), table.count(), table.where("pos >= 900").count(), few.count()] == [3, 50, 5, 3]
    assert table.where("pos < 100").union(table.where("pos >= 900")).count() == 10
