"""What only larger tables bring about: sums beyond 64 bits, many files an arrival, batches of many rows."""

import os
import subprocess
import sys
import time
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusflow.llm.common import SHUFFLE_CLEANUP, small_batches, staged
from corpusflow.operators import codec
from corpusflow.operators.vocabulary import Vocabulary

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_sums_by_position_beyond_64_bits(spark):
    far = 1 << 40
    rows = [("train", far + 65536 * i, j, 250) for i in range(200) for j in range(200)] + [("validation", 0, 0, 7)]
    sums = entry._token_sums(spark.createDataFrame(rows, "split STRING, pos BIGINT, i INT, token INT"))
    # 64 bits end at 9.2e18
    got = {r["split"]: r for r in entry._as_long(sums, "weighted_sum").collect()}
    want = sum((pos + i + 1) * token for split, pos, i, token in rows if split == "train")
    assert want > 2**63 and got["train"]["weighted_sum"] == Decimal(want)
    assert (got["train"]["n_tokens"], got["train"]["token_sum"]) == (40_000, 250 * 40_000)
    small = entry._as_long(sums.where("split = 'validation'"), "weighted_sum")
    assert small.schema["weighted_sum"].dataType.simpleString() == "bigint" and small.first()["weighted_sum"] == 7


@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    """Documents whose ids are spread over many files, one without an id."""
    folder = tmp_path_factory.mktemp("scattered")
    rows = [(i, f"document {i} " + "word " * (i * 37 % 90), "en", f"s{i % 3}", 1) for i in range(0, 400, 2)]
    rows += [(None, "no id " * 70, "en", "s1", 1), (7, "", "en", "s1", 0), (9, None, "en", "s1", None)]
    documents = spark.createDataFrame(rows, entry.DOCUMENT_SCHEMA)
    documents.repartition(9).write.parquet(f"{folder}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return str(folder), connection


@pytest.mark.parametrize(
    "name", ["stream_windows", "stream_windows_by_source", "stream_encode", "stream_stats", "token_bin_append", "token_bin_arriving_windows"]
)
def test_documents_arrive_in_id_order_from_many_files(spark, scattered, name):
    folder, connection = scattered
    got = entry.own_queries()[name](spark, folder)
    want = connection.execute(entry.own_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_a_part_is_one_micro_batch_however_many_files_it_has(spark, scattered):
    parts = []
    for live in entry._arrivals(spark, scattered[0]):
        parts.append(live.isStreaming)
    assert len(parts) == entry.PARTS + 1  # and one of documents without an id


def test_ids_come_in_slices(monkeypatch):
    vocab = Vocabulary()
    rows = [["ab", "c"], None, [], ["é"] * 9, ["ab", "x" * 70, "ab"], ["q"], ["c"]]
    monkeypatch.setattr(codec, "CHUNKS_AT_ONCE", 3)
    monkeypatch.setattr(codec, "BYTES_AT_ONCE", 2)
    chunks = pa.array([["not"], *rows], pa.list_(pa.string()))[1:]
    slices = list(codec.encode_slices(chunks, codec.pair_table(vocab), vocab.ranks))
    assert len(slices) > 2 and max(len(s.flatten()) for s in slices) < 80
    want = [None if row is None else [b for chunk in row for b in chunk.encode()] for row in rows]
    assert [ids for s in slices for ids in s.to_pylist()] == want


def test_shuffle_files_go_with_the_end_of_a_write(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return sum(1 for name in map(str, disk.getAllFiles().mkString("\n").split("\n")) if "/shuffle_" in name)

    before = files()
    rows = spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
    table = staged(rows, "counted")
    until = time.time() + 30
    while files() > before and time.time() < until:  # they are deleted beside what runs next
        time.sleep(0.2)
    assert files() <= before
    assert sorted(map(tuple, table.collect())) == [(k, len(range(k, 1000, 7))) for k in range(7)]
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_texts_go_to_python_in_small_batches_and_without_pandas(spark):
    def batch_sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    rows = spark.range(0, 5000, 1, 1)
    with small_batches(spark):
        sizes = [n for n, in rows.mapInArrow(batch_sizes, "n BIGINT").collect()]
    assert max(sizes) == 2000 and sum(sizes) == 5000
    assert rows.mapInArrow(batch_sizes, "n BIGINT").first()[0] == 5000  # as before afterwards
    # a worker that imports the operators of the pipeline's first stages has no use for it
    code = "import sys, corpusflow.llm.linedup, corpusflow.llm.simhash, corpusflow.llm.toxicity; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0
