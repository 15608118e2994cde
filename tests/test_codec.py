import random

import pyarrow as pa
import pytest
import tiktoken
from conftest import EDGE_TEXTS
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from sequential import train

from corpusflow.functions.pretokenize import SPLIT_PATTERN
from corpusflow.operators.bpe import chunk_freq, learn_merges
from corpusflow.operators.codec import (
    cut_at_eos,
    decode,
    decode_ids,
    encode,
    encode_batch,
    encode_ids,
    merge_long_chunk,
    pair_table,
    prepare_prompts,
    roundtrip_report,
    strip_special,
)
from corpusflow.operators.vocabulary import Merge, Vocabulary

BYTES = Vocabulary()


def published_codec(vocab, pattern=SPLIT_PATTERN):
    return tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=vocab.ranks, special_tokens={})


@pytest.fixture(scope="module")
def learned(documents):
    return learn_merges(chunk_freq(documents), 290).vocab


@pytest.mark.parametrize("seed", range(40))
def test_merging_equals_the_published_codec(seed):
    rng = random.Random(seed)
    letters = "abc"[: rng.choice([1, 2, 3])]
    chunks = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(20)]
    vocab = Vocabulary([Merge(*m) for m in train(dict.fromkeys(chunks, 1), rng.randint(1, 40))])
    assert len(vocab.ranks) == len(vocab.tokens)
    chunks += ["".join(rng.choice(letters + "d") for _ in range(n)) for n in (1, 5, 63, 64, 65, 300, 2000)] + ["", "é "]
    rng.shuffle(chunks)
    rows = [chunks[i : i + 6] for i in range(0, len(chunks), 6)] + [None, []]
    codec = published_codec(vocab, "(?s:.+)")
    want = [None if row is None else [i for c in row for i in codec.encode_ordinary(c)] for row in rows]
    assert encode_batch(pa.array(rows, pa.list_(pa.string())), pair_table(vocab), vocab.ranks).to_pylist() == want
    assert all(merge_long_chunk(c.encode(), vocab.ranks) == codec.encode_ordinary(c) for c in chunks)


def test_sliced_arrow_arrays():
    rows = pa.array([["ab"], ["c", "d"], None, ["ee"]], pa.list_(pa.string())).slice(1, 3)
    assert encode_batch(rows, pair_table(BYTES), BYTES.ranks).to_pylist() == [[99, 100], None, [101, 101]]


def test_encode_equals_the_published_codec_on_whole_texts(documents, edge, learned):
    codec = published_codec(learned)
    rows = edge.unionByName(documents.select("doc_id", "text")).select("text", F.col("text").alias("t"))
    for row in encode(rows, learned).collect():
        assert row.ids == [learned.bos_id, *codec.encode_ordinary(row.t), learned.eos_id]
        assert (row.char_len, row.token_len) == (len(row.t), len(row.ids))


def test_only_empty_and_null_are_dropped(edge):
    assert encode(edge, BYTES).count() == len(EDGE_TEXTS)


def test_special_names_in_text_are_ordinary(spark):
    row = encode(spark.createDataFrame([("<eos>",)], "text STRING"), BYTES).collect()[0]
    assert row.ids == [258, *b"<eos>", 257]


def test_round_trip(documents, edge, learned):
    for vocab in (BYTES, learned):
        rows = edge.select("text").unionByName(documents.select("text"))
        report = roundtrip_report(rows, vocab).collect()[0]
        assert (report.documents, report.mismatches) == (len(EDGE_TEXTS) + 200, 0)


def test_decode_of_broken_utf8_and_specials(spark):
    rows = [[0xE2, 0x82], [0xFF, 65, 0xF0, 0x9F, 0x98], [0xE2, 0x82, 0xAC], [], [0xC0, 0x80, 0xED, 0xA0, 0x80]]
    df = spark.createDataFrame([(r,) for r in rows], "ids ARRAY<INT>").select("ids", decode_ids(BYTES, "ids").alias("t"))
    for row in df.collect():
        assert row.t == bytes(row.ids).decode("utf-8", "replace")
    text = spark.createDataFrame([([258, 72, 105, 257],)], "ids ARRAY<INT>").select(decode_ids(BYTES, "ids")).first()[0]
    assert text == "<bos>Hi<eos>"
    with pytest.raises(PySparkException):
        spark.createDataFrame([([260],)], "ids ARRAY<INT>").select(decode_ids(BYTES, "ids")).collect()


def test_strip_special(spark):
    df = spark.createDataFrame([([258, 1, 2, 257],), ([258, 257],)], "ids ARRAY<INT>")
    assert [r[0] for r in df.select(strip_special("ids")).collect()] == [[1, 2], []]


@pytest.mark.parametrize("add_bos", [True, False])
@pytest.mark.parametrize("length", [1, 4, 5, 6, 100])
def test_prompts_keep_the_last_ids(spark, add_bos, length):
    df = spark.createDataFrame([("hello",), ("",)], "text STRING")
    whole = [[258] * add_bos + list(t.encode()) for t in ("hello", "")]
    got = [row.ids for row in prepare_prompts(df, BYTES, length, add_bos).collect()]
    assert got == [ids[-length:] for ids in whole]


def test_cut_at_eos(spark):
    df = spark.createDataFrame([([1, 9, 2, 9],), ([1, 2, 3],), ([9],), ([],)], "ids ARRAY<INT>")
    assert [r[0] for r in df.select(cut_at_eos("ids", 9, 10)).collect()] == [[1, 9], [1, 2, 3], [9], []]
    assert [r[0] for r in df.select(cut_at_eos("ids", 9, 1)).collect()] == [[1], [1], [9], []]
    assert [r[0] for r in df.select(cut_at_eos("ids", 9, 0)).collect()] == [[], [], [], []]


def test_encoding_shuffles_nothing(documents):
    assert "Exchange" not in encode(documents, BYTES)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("ids", [[104, 999, 105], [104, 105, -100, -100], [104, None]])
def test_unknown_ids_raise(spark, ansi, ids):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="no token has the id"):
            decode(spark.createDataFrame([(ids,)], "ids ARRAY<INT>"), Vocabulary()).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
