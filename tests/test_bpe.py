import itertools
import random
from collections import Counter

import pytest
import regex
from conftest import EDGE_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sequential import count, merge_once, train

from corpusflow.functions.pretokenize import SPLIT_PATTERN, pretokenize, symbol, token_of
from corpusflow.operators import bpe
from corpusflow.operators.bpe import chunk_freq, independent_prefix, learn_merges, pair_table
from corpusflow.operators.vocabulary import Merge, Vocabulary


def test_pretokenize_equals_the_pattern_and_loses_nothing(edge, documents):
    for row in edge.unionByName(documents.select("doc_id", "text")).select("text", pretokenize("text").alias("c")).collect():
        if row.text is not None:
            assert row.c == regex.findall(SPLIT_PATTERN, row.text)
            assert "".join(row.c) == row.text


def test_chunk_freq_and_byte_pairs(documents):
    want = Counter(chunk for row in documents.collect() for chunk in regex.findall(SPLIT_PATTERN, row.text))
    freq = chunk_freq(documents)
    assert {row.chunk: row.freq for row in freq.collect()} == want
    pairs = {(r.left_id, r.right_id): r.pair_freq for r in pair_table(freq).collect()}
    assert pairs == count([(list(c.encode()), n) for c, n in want.items()])


def test_symbols_step_over_surrogates():
    for token_id in (0, 255, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 300_000):
        assert token_of(symbol(token_id)) == token_id
        symbol(token_id).encode()


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1, max_size=12), st.integers(1, 4), min_size=1, max_size=8))
def test_batched_merges_equal_one_at_a_time(freqs):
    wanted = train(freqs, 30)
    states = [(list(chunk.encode()), freq) for chunk, freq in freqs.items()]
    made = []
    while len(made) < 30:
        ranked = sorted(((*pair, n) for pair, n in count(states).items()), key=lambda p: (-p[2], p[:2]))
        batch = independent_prefix(ranked, 30 - len(made))
        if not batch:
            break
        for merge in batch:
            new = 256 + len(made)
            states = [(merge_once(ids, merge.left_id, merge.right_id, new), n) for ids, n in states]
            made.append((merge.left_id, merge.right_id, merge.pair_freq))
    assert made == wanted


def merges_of(run):
    return [(m.left_id, m.right_id, m.pair_freq) for m in run.vocab.merges]


def test_ties_self_pairs_and_early_exhaustion(spark):
    freqs = {"aaaa": 3, "abab": 5, "aab": 5, "ba": 5}
    run = learn_merges(spark.createDataFrame(list(freqs.items()), "chunk STRING, freq BIGINT"), 300)
    assert merges_of(run) == train(freqs, 40)
    assert run.vocab.n_vocab < 300  # no pair was left
    assert run.vocab.specials == {
        role: 256 + len(run.vocab.merges) + i for i, role in enumerate(("pad", "eos", "bos", "unk"))
    }


def test_learning_equals_a_sequential_trainer_over_several_bases(spark):
    rng = random.Random(5)
    freqs = {"".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 25))): rng.randint(1, 9) for _ in range(200)}
    run = learn_merges(spark.createDataFrame(list(freqs.items()), "chunk STRING, freq BIGINT"), 350)
    assert merges_of(run) == train(freqs, 90)


@pytest.mark.parametrize("candidates, index_from, indexed", [(3, 10**9, 1), (40, 0, 2), (40, 9, 40)])
def test_few_candidates_give_the_same_merges(spark, monkeypatch, candidates, index_from, indexed):
    """Pairs that the driver does not count come up again in a new base, ties at the floor among them."""
    monkeypatch.setattr(bpe, "CANDIDATES", candidates)
    monkeypatch.setattr(bpe, "INDEX_FROM", index_from)
    monkeypatch.setattr(bpe, "INDEXED_PAIRS", indexed)
    monkeypatch.setattr(bpe, "MERGES_PER_BASE", (9, 9))
    rng = random.Random(candidates)
    freqs = {"".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 12))): rng.randint(1, 3) for _ in range(60)}
    freqs |= {"pq": 1, "rs": 1, "tu": 1, "vw": 1, "xy": 1}
    run = learn_merges(spark.createDataFrame(list(freqs.items()), "chunk STRING, freq BIGINT"), 260 + 45)
    assert merges_of(run) == train(freqs, 45)


@pytest.mark.parametrize("index_from", [0, 10**9])
def test_a_round_looks_at_chunks_with_a_taken_pair_alone(spark, monkeypatch, index_from):
    monkeypatch.setattr(bpe, "INDEX_FROM", index_from)
    freqs = {f"{a}{b}x{i}": 1 for i, (a, b) in enumerate(itertools.product("abcdefgh", repeat=2))} | {"qz" * 9: 5, "qzq": 1, "zq": 1}
    base = bpe._Base(bpe.chunk_states(spark.createDataFrame(list(freqs.items()), "chunk STRING, freq BIGINT")), 0)
    q, z = ord("q"), ord("z")
    assert sorted(r.symbols for r in base.holders([Merge(q, z, 0)]).collect()) == ["qzq", "qz" * 9]
    base.merge([Merge(q, z, 0)])
    # a pair of a new token is looked up by what the token was made of
    assert sorted(r.symbols for r in base.holders([Merge(256, 256, 0), Merge(256, q, 0)]).collect()) == ["qzq", "qz" * 9]
    assert base.counts[symbol(256) + symbol(256)] == 40 and base.counts[symbol(256) + "q"] == 1
    # both pairs in one batch: a chunk with both is looked at once
    assert base.holders([Merge(q, z, 0), Merge(z, q, 0)]).count() == 3
    assert (base.index is None) == (index_from > 0)
    base.drop()


def test_documents_vocabulary(documents):
    freqs = {row.chunk: row.freq for row in chunk_freq(documents).collect()}
    run = learn_merges(chunk_freq(documents), 284)
    assert merges_of(run) == train(freqs, 24)
    report = run.report(documents.sparkSession).collect()[0]
    assert (report.vocab_size, report.merges, report.rounds) == (284, 24, run.rounds)


def test_vocab_size_must_hold_bytes_and_specials(spark):
    freq = spark.createDataFrame([("ab", 1)], "chunk STRING, freq BIGINT")
    with pytest.raises(ValueError):
        learn_merges(freq, 259)
    assert learn_merges(freq, 260).vocab.n_vocab == 260


def test_vocabulary_table_round_trip(spark, tmp_path):
    vocab = Vocabulary([Merge(97, 98, 7), Merge(256, 99, 3)], {"pad": "[P]", "eos": "[E]", "bos": "[B]", "unk": "[U]"})
    vocab.save(spark, str(tmp_path / "v"))
    again = Vocabulary.load(spark, str(tmp_path / "v"))
    assert again == vocab and again.tokens[257] == b"abc" and again.token_id("[E]") == 259
    rows = vocab.to_df(spark).orderBy(F.desc("token_id")).limit(4).collect()
    assert [r.name for r in rows] == ["[U]", "[B]", "[E]", "[P]"]
    with pytest.raises(KeyError):
        vocab.token_id("<eos>")


def test_dtype_rule():
    def vocab_of(n):
        vocab = Vocabulary()
        vocab.tokens = [b""] * (n - 4)
        return vocab.dtype

    assert (vocab_of(65535), vocab_of(65536)) == ("uint16", "uint32")
