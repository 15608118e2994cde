import random
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sequential import windows as plain_windows

from corpusflow.functions.ordering import with_hash_order, with_id_order
from corpusflow.operators.codec import encode
from corpusflow.operators.split import holdout_split
from corpusflow.operators.stats import corpus_metadata, corpus_stats
from corpusflow.operators.stream import token_offsets, token_prefix
from corpusflow.operators.vocabulary import Vocabulary
from corpusflow.operators.windows import batch, pack_windows, window_count, window_counts
from corpusflow.sources.token_bin import (
    TokenBinReader,
    copy_prefix,
    list_shards,
    read_manifest,
    read_tokens,
    read_windows,
    token_count,
    write_stream,
    write_tokens,
)

EOS = 9


def encoded(spark, docs, split="train"):
    """Documents given as ``{doc_id: ids}``, in id order."""
    rows = [(split, doc_id, ids, len(ids)) for doc_id, ids in docs.items()]
    df = spark.createDataFrame(rows, "split STRING, doc_id BIGINT, ids ARRAY<INT>, token_len INT")
    return with_id_order(df)


def stream_of(spark, docs, **options):
    return token_offsets(encoded(spark, docs), **options)


def collected(windows):
    return [(row.x, row.y) for row in windows.orderBy("window_id").collect()]


# the two published cases


def test_window_count_and_shift(spark, tmp_path):
    tokens = list(range(1, 11))
    np.array(tokens, np.uint16).tofile(tmp_path / "train.bin")
    from_file = collected(read_windows(spark, str(tmp_path / "train.bin"), 4, 2))
    assert len(from_file) == 3 and from_file[0] == ([1, 2, 3, 4], [2, 3, 4, 5])
    assert collected(pack_windows(stream_of(spark, {0: tokens}), 4, 2)) == from_file


def test_targets_from_the_first_eos_on_are_ignored(spark, tmp_path):
    tokens = [1, 3, 5, 6, 7, 8]
    np.array(tokens, np.uint16).tofile(tmp_path / "val.bin")
    masked = read_windows(spark, str(tmp_path / "val.bin"), 4, 4, eos_id=3, mask_after_eos=True)
    assert collected(masked) == [([1, 3, 5, 6], [3, -100, -100, -100])]
    assert collected(pack_windows(stream_of(spark, {0: tokens}), 4, 4, 3, ["train"])) == collected(masked)


# counts and edges


@pytest.mark.parametrize("n, block, stride, count", [(5, 4, 4, 1), (6, 4, 4, 1), (9, 4, 4, 2), (9, 4, 1, 5), (10, 4, 2, 3)])
def test_window_count(n, block, stride, count):
    assert window_count(n, block, stride) == count


@pytest.mark.parametrize("n, block, stride", [(4, 4, 4), (0, 4, 4), (9, 0, 1), (9, 4, 0), (9, 4, 5)])
def test_window_arguments(n, block, stride):
    with pytest.raises(ValueError):
        window_count(n, block, stride)


def test_masking_needs_eos(spark, tmp_path):
    with pytest.raises(ValueError, match="EOS"):
        pack_windows(stream_of(spark, {0: [1] * 9}), 4, 4, None, ["train"])
    with pytest.raises(ValueError, match="EOS"):
        read_windows(spark, str(tmp_path), 4, 4, mask_after_eos=True)


@pytest.mark.parametrize(
    "tokens",
    [
        [EOS, 1, 2, 3, 4],  # first position
        [1, 2, 3, EOS, 4],  # last position of x
        [1, 2, 3, 4, EOS],  # only in y: masks nothing
        [EOS, EOS, 1, EOS, 2, 3, 4, EOS, 5],
    ],
)
def test_mask_edges(spark, tokens):
    got = collected(pack_windows(stream_of(spark, {0: tokens}), 4, 4, EOS, ["train"]))
    assert got == plain_windows(tokens, 4, 4, EOS)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 2**31), st.integers(1, 12), st.data())
def test_windows_equal_the_plain_loop(spark, seed, block, data):
    stride = data.draw(st.integers(1, block))
    rng = random.Random(seed)
    docs = {i: [rng.randint(0, EOS) for _ in range(rng.choice([1, 2, 3, 40]))] for i in range(20)}
    tokens = [t for ids in docs.values() for t in ids]
    stream = stream_of(spark, docs, tokens_per_bucket=rng.choice([1, 16, 1 << 20]))
    assert collected(pack_windows(stream, block, stride, EOS, ["train"])) == plain_windows(tokens, block, stride, EOS)
    unmasked = collected(pack_windows(stream, block, block))
    assert [t for x, _ in unmasked for t in x] == tokens[: len(unmasked) * block]


def test_lookup_of_a_window_range(spark):
    docs = {i: [i % 10] * 7 for i in range(30)}
    stream = stream_of(spark, docs)
    whole = collected(pack_windows(stream, 8, 5))
    assert collected(pack_windows(stream, 8, 5, window_range=(3, 11))) == whole[3:12]
    for bad in ((-1, 2), (5, 4), (0, len(whole))):
        with pytest.raises(IndexError):
            pack_windows(stream, 8, 5, window_range=bad)


def test_batches_drop_the_last_only_where_asked(spark):
    docs = encoded(spark, {i: [1] * 9 for i in range(10)})
    stream = token_offsets(docs.unionByName(docs.withColumn("split", F.lit("validation"))))
    counts = window_counts(stream.totals, 4, 4)
    assert counts == {"train": 22, "validation": 22}
    rows = batch(pack_windows(stream, 4, 4), 5, counts, ["train"]).collect()
    assert {(r.split, r.batch_id) for r in rows} == {("train", b) for b in range(4)} | {("validation", b) for b in range(5)}
    assert all(r.window_id == r.batch_id * 5 + r.row_in_batch for r in rows)
    with pytest.raises(ValueError):
        batch(pack_windows(stream, 4, 4), 0, counts)


# the stream


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_offsets_do_not_depend_on_partitions(spark, documents, partitions):
    vocab = Vocabulary()
    rows = encode(holdout_split(documents.select("doc_id", "text").repartition(partitions), 0.1, 1), vocab)
    stream = token_offsets(rows.cache())
    for split in ("train", "validation"):
        got = stream.segments.where(F.col("split") == split).orderBy("order_key", "doc_id").collect()
        starts = list(accumulate([row.token_len for row in got], initial=0))
        assert [row.offset for row in got] == starts[:-1] and stream.totals[split] == starts[-1]


@pytest.mark.parametrize("ids", [range(500), [i**5 for i in range(500)], [-(2**62) + i for i in range(250)] + [2**62 + i for i in range(250)]])
def test_offsets_of_clustered_ids(spark, ids):
    docs = {doc_id: [1] * (doc_id % 5 + 1) for doc_id in ids}
    got = stream_of(spark, docs, tokens_per_bucket=1).segments.orderBy("doc_id").collect()
    assert [row.offset for row in got] == list(accumulate([len(docs[i]) for i in sorted(docs)], initial=0))[:-1]


def test_one_source_with_most_rows(spark):
    rows = [("big" if i % 10 else "small", i, 3) for i in range(3000)]
    df = with_hash_order(spark.createDataFrame(rows, "split STRING, doc_id BIGINT, token_len INT"), 5)
    got = token_offsets(df, tokens_per_bucket=50)
    assert got.totals == {"big": 8100, "small": 900}
    for split, total in got.totals.items():
        offsets = sorted(r.offset for r in got.segments.where(F.col("split") == split).collect())
        assert offsets == list(range(0, total, 3))


@pytest.mark.parametrize("limit", [0, 1, 7, 20, 21, 1000])
def test_prefix(spark, limit):
    docs = {i: list(range(i, i + 6)) for i in range(5)}
    tokens = [t for ids in docs.values() for t in ids]
    rows = token_prefix(stream_of(spark, docs), limit).orderBy("offset").collect()
    assert [t for row in rows for t in row.ids] == tokens[:limit]
    assert all(len(row.ids) == row.token_len for row in rows)


def test_negative_prefix_is_an_error(spark):
    with pytest.raises(ValueError):
        token_prefix(stream_of(spark, {0: [1]}), -1)


def test_token_arrays_are_shuffled_once(spark, tmp_path):
    encoded(spark, {i: [1] * 50 for i in range(50)}).write.parquet(str(tmp_path / "e"))
    plan = pack_windows(token_offsets(spark.read.parquet(str(tmp_path / "e"))), 8, 8)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # one by (split, bucket), reused, and one of border windows
    assert len([s for s in shuffles if "ReusedExchange" not in s]) == 2 and "ReusedExchange" in text


# statistics


def test_stats_and_metadata(spark):
    df = spark.createDataFrame(
        [("train", 3, 5), ("train", 5, 9)], "split STRING, char_len INT, token_len INT"
    )
    row = corpus_stats(df).collect()[0]
    assert tuple(row) == ("train", 2, 14, 3.0, 5.0, 4.0, 5.0, 9.0, 7.0)
    meta = corpus_metadata(df, Vocabulary(), False, 0.05, 42).collect()[0].asDict(recursive=True)
    assert meta["train_length_stats"] == {"char": dict(min=3.0, max=5.0, mean=4.0), "token": dict(min=5.0, max=9.0, mean=7.0)}
    assert (meta["val_tokens"], meta["val_examples"], meta["val_length_stats"]) == (0, 0, None)
    assert (meta["dtype"], meta["eos_token_id"], meta["seed"], meta["val_split"]) == ("uint16", 257, 42, 0.05)
    assert "seed" not in corpus_metadata(df, Vocabulary(), True).columns


# token files


def test_stream_to_shards_and_back(spark, documents, tmp_path):
    vocab = Vocabulary()
    stream = token_offsets(encode(holdout_split(documents.select("doc_id", "text"), 0.1, 1), vocab).cache(), tokens_per_bucket=20_000)
    for _ in range(2):  # the second run replaces the first
        write_stream(stream, str(tmp_path / "s"), "uint16")
    for split, total in stream.totals.items():
        path = f"{tmp_path}/s/{split}"
        ordered = stream.segments.where(F.col("split") == split).orderBy("offset").collect()
        tokens = [t for row in ordered for t in row.ids]
        rows = read_tokens(spark, path, row_tokens=1000, range_tokens=7000).orderBy("pos").collect()
        assert [t for row in rows for t in row.tokens] == tokens and token_count(path, "uint16") == total
        manifest = read_manifest(spark, path).orderBy("first_offset").collect()
        assert sum(r.n_tokens for r in manifest) == total and manifest[0].first_offset == 0
        assert len(list((tmp_path / "s" / split).glob("*.bin"))) == len(manifest)
        got = read_windows(spark, path, 64, 48, eos_id=257, mask_after_eos=True, row_tokens=500, range_tokens=5000)
        assert collected(got) == plain_windows(tokens, 64, 48, 257)


def test_rows_in_any_order_give_the_same_stream(spark, tmp_path):
    rows = [(i * 3, [i, i + 1, i + 2]) for i in range(50)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "offset BIGINT, ids ARRAY<INT>").repartition(4)
    write_tokens(df, str(tmp_path / "t"))
    got = [t for r in read_tokens(spark, str(tmp_path / "t")).orderBy("pos").collect() for t in r.tokens]
    assert got == [t for i in range(50) for t in (i, i + 1, i + 2)]


def test_gap_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(0, [1]), (2, [1])], "offset BIGINT, ids ARRAY<INT>")
    with pytest.raises(Exception, match="gap"):
        write_tokens(df, str(tmp_path / "g"))


def test_wide_ids(spark, tmp_path):
    ids = [65_535, 65_536, 4_000_000_000, 3, 5]
    df = spark.createDataFrame([(0, ids)], "offset BIGINT, ids ARRAY<BIGINT>")
    with pytest.raises(Exception, match="do not fit"):
        write_tokens(df, str(tmp_path / "narrow"), "uint16")
    write_tokens(df, str(tmp_path / "wide"), "uint32")
    assert read_tokens(spark, str(tmp_path / "wide"), "uint32").collect()[0].tokens == ids
    window = read_windows(spark, str(tmp_path / "wide"), 4, 4, "uint32", eos_id=65_536, mask_after_eos=True).collect()[0]
    assert (window.x, window.y) == (ids[:4], [65_536, -100, -100, -100])
    with pytest.raises(ValueError, match="holds uint32"):
        list_shards(str(tmp_path / "wide"), "uint16")


def test_unaligned_file_and_too_few_tokens(spark, tmp_path):
    (tmp_path / "odd.bin").write_bytes(b"123")
    with pytest.raises(ValueError, match="multiple"):
        read_windows(spark, str(tmp_path / "odd.bin"), 1, 1)
    (tmp_path / "short.bin").write_bytes(b"1234")
    with pytest.raises(ValueError, match="not enough"):
        read_windows(spark, str(tmp_path / "short.bin"), 2, 1)
    with pytest.raises(ValueError, match="dtype"):
        list_shards(str(tmp_path / "short.bin"), "int8")
    with pytest.raises(FileNotFoundError):
        list_shards(str(tmp_path / "none.bin"), "uint16")


@pytest.mark.parametrize("limit", [0, 5, 10, 99])
def test_copy_prefix(spark, tmp_path, limit):
    np.arange(10, dtype=np.uint16).tofile(tmp_path / "a.bin")
    copy_prefix(spark, str(tmp_path / "a.bin"), str(tmp_path / "out"), limit)
    got = [t for r in read_tokens(spark, str(tmp_path / "out"), row_tokens=3).orderBy("pos").collect() for t in r.tokens]
    assert got == list(range(10))[:limit]


def test_shards_without_a_manifest_are_an_error(spark, tmp_path):
    df = spark.createDataFrame([(0, [1, 2, 3])], "offset BIGINT, ids ARRAY<INT>")
    write_tokens(df, str(tmp_path / "t"))
    (tmp_path / "t" / "manifest.json").unlink()
    with pytest.raises(ValueError, match="no manifest"):
        list_shards(str(tmp_path / "t"), "uint16")


def test_only_wanted_ranges_are_planned(spark, tmp_path):
    shards = [(1000 * i, list(range(1000))) for i in range(10)]
    write_tokens(spark.createDataFrame(shards, "offset BIGINT, ids ARRAY<INT>").repartition(10, "offset"), str(tmp_path / "t"))
    options = {"path": str(tmp_path / "t"), "row_tokens": "100", "range_tokens": "500"}
    ranges = TokenBinReader({**options, "stop": "1050"}).partitions()
    assert sum(r.stop_row - r.first_row for r in ranges) == 11
    assert {s.first for r in ranges for s in r.shards} == {0, 1000}
    windows = TokenBinReader({**options, "block_size": "20", "stride": "10", "first": "455", "stop": "457"})
    assert [(r.first_row, r.stop_row) for r in windows.partitions()] == [(45, 46)]
    assert {s.first for r in windows.partitions() for s in r.shards} == {4000}
    assert TokenBinReader({**options, "stop": "0"}).partitions() == []


@pytest.mark.parametrize("wanted", [(0, 0), (3, 9), (190, 197)])
def test_window_range_of_files(spark, tmp_path, wanted):
    write_tokens(spark.createDataFrame([(0, list(range(2000)))], "offset BIGINT, ids ARRAY<INT>"), str(tmp_path / "t"))
    path = str(tmp_path / "t")
    every = {r.window_id: r.x for r in read_windows(spark, path, 20, 10, row_tokens=50).collect()}
    some = {r.window_id: r.x for r in read_windows(spark, path, 20, 10, window_range=wanted, row_tokens=50).collect()}
    assert some == {w: every[w] for w in range(wanted[0], wanted[1] + 1)}
    with pytest.raises(IndexError):
        read_windows(spark, path, 20, 10, window_range=(0, 198))


@pytest.mark.parametrize("ids", [
    [(file << 36) + row for file in range(8) for row in range(3000)],
    [*range(12_000), *range(10**15, 10**15 + 12_000)],
])
def test_no_cell_is_hot(spark, ids):
    encoded = spark.createDataFrame([(i,) for i in ids], "doc_id BIGINT").selectExpr("'train' AS split", "doc_id", "3 AS token_len")
    stream = token_offsets(with_id_order(encoded), tokens_per_bucket=3 * len(ids) // 256)
    sizes = [row.bucket_end - row.bucket_start for row in stream.buckets.collect()]
    assert max(sizes) <= 2 * 3 * len(ids) / 256
    rows = sorted((r.doc_id, r.offset) for r in stream.segments.collect())
    assert rows == [(i, 3 * n) for n, i in enumerate(sorted(ids))]


def test_long_document_with_small_stride(spark):
    """One document of many windows: no row holds more than the pieces of one stretch."""
    n, block = 60_000, 512
    encoded = spark.createDataFrame([(1,)], "doc_id BIGINT").selectExpr("'train' AS split", "doc_id", f"sequence(0, {n - 1}) AS ids", f"{n} AS token_len")
    windows = pack_windows(token_offsets(with_id_order(encoded)), block, 1)
    row = windows.selectExpr("count(*) AS n", "sum(x[0]) AS first", "min(y[511] - x[0]) AS low", "max(y[511] - x[0]) AS high").first()
    assert (row.n, row.first) == (n - block, sum(range(n - block))) and row.low == row.high == block


@pytest.mark.parametrize("case", ["repeated ids", "clustered ids", "one id", "few positions", "giant documents"])
def test_no_bucket_is_over_twice_the_target(spark, monkeypatch, case):
    """However ids repeat or cluster, buckets are even, and offsets are those of the plain order."""
    from corpusflow.operators import ranges

    monkeypatch.setattr(ranges, "FAN", 8)  # several rounds
    rng = random.Random(3)
    ids = {
        "repeated ids": lambda i: rng.choice([1, 1, 1, 2, 10**12]),
        "clustered ids": lambda i: rng.choice([rng.randrange(40), 2**60 + rng.randrange(10**6), -(2**62) + i]),
        "one id": lambda i: 7,
        "few positions": lambda i: i // 500,
        "giant documents": lambda i: i,
    }[case]
    lengths = [50_000 if case == "giant documents" and i % 900 == 450 else rng.randrange(1, 60) for i in range(3000)]
    rows = [(ids(i), n, [i] * min(n, 3)) for i, n in enumerate(lengths)]
    df = with_id_order(spark.createDataFrame(rows, "doc_id BIGINT, token_len INT, ids ARRAY<INT>").withColumn("split", F.lit("train"))).cache()
    target = 700
    stream = token_offsets(df, tokens_per_bucket=target)
    buckets = stream.buckets.orderBy("bucket").collect()
    assert buckets[0].bucket_start == 0 and buckets[-1].bucket_end == stream.totals["train"] == sum(lengths)
    assert all(a.bucket_end == b.bucket_start for a, b in zip(buckets, buckets[1:]))
    long = [b for b in buckets if b.bucket_end - b.bucket_start > 2 * target]
    assert len(long) == (sum(n > 2 * target for n in lengths) if case == "giant documents" else 0)
    assert len(buckets) < 4 * sum(lengths) / target
    got = [(r.doc_id, r.token_len, r.offset) for r in stream.segments.orderBy("offset").collect()]
    want, at = [], 0
    for doc_id, n, _ in sorted(rows, key=lambda r: r[:2]):
        want.append((doc_id, n, at))
        at += n
    assert got == want
    assert sorted(map(tuple, stream.segments.select("offset", "ids").collect())) == sorted(map(tuple, token_offsets(df.repartition(3), tokens_per_bucket=target).segments.select("offset", "ids").collect()))


def test_many_splits(spark):
    """The number of splits has no limit."""
    df = with_id_order(spark.range(12_000).select(F.col("id").alias("doc_id"), F.expr("'s' || (id % 6000)").alias("split"), F.lit(5).alias("token_len")))
    stream = token_offsets(df)
    assert len(stream.totals) == 6000 and set(stream.totals.values()) == {10}
    assert {tuple(r) for r in stream.segments.groupBy("offset").count().collect()} == {(0, 6000), (5, 6000)}
