import random

import pytest
from pyspark.sql import functions as F
from sequential import windows as plain_windows

from corpusflow.operators.codec import encode
from corpusflow.operators.stats import corpus_stats
from corpusflow.operators.vocabulary import Vocabulary
from corpusflow.streaming.append_pack import AppendPacker
from corpusflow.streaming.append_state import append_windows, continued_windows
from corpusflow.streaming.live import append_encoded, encode_stream, read_documents, running_stats, throughput_by_window

BYTES = Vocabulary()
SCHEMA = "doc_id BIGINT, text STRING"


def add(spark, folder, docs):
    spark.createDataFrame(docs, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_encode_stream_over_restarts_equals_batch(spark, documents, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(-1, ""), (-2, "tiny")]
    for part in range(3):
        add(spark, folder, rows[part::3])
        live = encode_stream(read_documents(spark, folder, SCHEMA, maxFilesPerTrigger=1), BYTES, 5)
        append_encoded(live, out, checkpoint).awaitTermination()
    got = spark.read.parquet(out)
    want = encode(spark.createDataFrame(rows, SCHEMA).where(F.char_length("text") >= 5), BYTES)
    assert got.count() == want.count() == 200
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_running_stats_equal_batch(spark, documents, tmp_path):
    schema = "doc_id BIGINT, text STRING, split STRING"
    parts = documents.select("doc_id", "text", F.col("source").alias("split"))
    parts.repartition(3).write.parquet(str(tmp_path / "in"))
    live = read_documents(spark, str(tmp_path / "in"), schema, maxFilesPerTrigger=1)
    query = (
        running_stats(encode_stream(live, BYTES))
        .writeStream.format("memory").queryName("running").outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("running").collect())) == sorted(
        map(tuple, corpus_stats(encode(parts, BYTES)).collect())
    )


@pytest.mark.parametrize("stride", [8, 5])
def test_append_packing_equals_one_stream(spark, tmp_path, stride):
    rng = random.Random(stride)
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    packer = AppendPacker(BYTES, str(tmp_path / "out"), 8, stride, mask=True)
    tokens, doc_id = [], 0
    for size in (1, 0, 4, 1, 7):  # the first batches are too short for a window
        docs = []
        for _ in range(size):
            text = "".join(rng.choice("abc ") for _ in range(rng.choice([1, 2, 30]) if doc_id else 2))
            docs.append((doc_id, text))
            tokens += [258, *text.encode(), 257]
            doc_id += 1
        if docs:
            add(spark, folder, docs)
        packer.start(read_documents(spark, folder if doc_id else folder, SCHEMA), checkpoint).awaitTermination()
    rows = packer.read(spark).orderBy("window_id").collect()
    assert [r.window_id for r in rows] == list(range(len(rows)))
    assert [(r.x, r.y) for r in rows] == plain_windows(tokens, 8, stride, 257)
    # running a batch again leaves everything as it was
    last = spark.read.parquet(f"{packer.target}/state").agg(F.max("batch_id")).first()[0]
    docs = spark.createDataFrame(docs, SCHEMA)
    packer(docs, last)
    again = packer.read(spark).orderBy("window_id").collect()
    assert again == rows


@pytest.mark.parametrize("stride", [8, 5])
def test_continued_windows_over_restarts_equal_one_stream_a_split(spark, tmp_path, stride):
    rng = random.Random(stride)
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema, tokens, doc_id = "split STRING, doc_id BIGINT, text STRING", {"a": [], "b": [], "tiny": []}, 0
    for size in (1, 6, 0, 9):
        docs = []
        for _ in range(size):
            split = rng.choice(["a", "a", "b"]) if doc_id else "tiny"
            text = "".join(rng.choice("abc ") for _ in range(rng.choice([1, 2, 30]) if doc_id else 2))
            docs.append((split, doc_id, text))
            tokens[split] += [258, *text.encode(), 257]
            doc_id += 1
        rng.shuffle(docs)
        if docs:
            spark.createDataFrame(docs, schema).coalesce(1).write.mode("append").parquet(folder)
        live = continued_windows(read_documents(spark, folder, schema), BYTES, 8, stride, masked=True)
        append_windows(live, out, checkpoint).awaitTermination()
    rows = spark.read.parquet(out).orderBy("split", "window_id").collect()
    for split, ids in tokens.items():
        got = [r for r in rows if r.split == split]
        assert [r.window_id for r in got] == list(range(len(got)))
        assert [(r.x, r.y) for r in got] == (plain_windows(ids, 8, stride, 257) if len(ids) > 8 else [])


def test_throughput_windows_close_behind_the_watermark(spark, tmp_path):
    rows = [(1, f"2024-01-01 00:00:{s:02d}", 10) for s in range(0, 60, 10)] + [(1, "2024-01-01 02:00:30", 5)]
    df = spark.createDataFrame(rows, "run_id INT, t STRING, n_tokens BIGINT")
    df.select("run_id", F.col("t").cast("timestamp_ntz").alias("ts"), "n_tokens").coalesce(1).write.parquet(str(tmp_path / "in"))
    live = read_documents(spark, str(tmp_path / "in"), "run_id INT, ts TIMESTAMP_NTZ, n_tokens BIGINT")
    query = (
        throughput_by_window(live).writeStream.format("memory").queryName("rates").outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.table("rates").collect()
    assert [(r.run_id, r.steps, r.n_tokens, r.tokens_per_sec) for r in got] == [(1, 6, 60, 1.0)]
