"""Merkle manifest, ranked search and source mixing against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from corpusflow.llm import curriculum, lexical, merkle
from corpusflow.llm.placing import placed
from corpusflow.llm.queries import QUERIES
from corpusflow.llm.sql import ORACLE_SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, one id twice, and columns whose names clash."""
    rows = [
        (1, "a", "en", "s", 1),
        (2, None, None, None, None),
        (None, "b", None, "s", 3),
        (3, "", "en", "t", 0),
        (3, "x", "en", "t", 1),
        (3, "x", "en", "t", 1),
        (4, "é " * 400_000, "é", "s", 800_000),
        (5, "w" * 300_000, "", None, None),
        (-7, "a b c", "fr", "\U0001f600", 5),
        (10, "c d\u0085e \x0b f", None, "￿", 9),
    ]
    return spark.createDataFrame([(*row, "extra", 1) for row in rows], DOCUMENTS + ", Doc_ID STRING, place INT")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.mark.parametrize("name", ["op11_octopus_multiproof", "op12_document_fp_tree", "op13_time_varying_curriculum"])
def test_query_against_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/sf0.001/{table}.parquet'")
    want = connection.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, f"{TESTDATA}/sf0.001").select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_places_and_running_sums(spark):
    rows = spark.range(1000).select(F.expr("id * 7919 % 1000").alias("a"), F.expr("IF(id % 5 = 0, NULL, id)").alias("n"))
    got = sorted(placed(rows, [F.col("a")], ("n",))[0].collect(), key=lambda r: r.a)
    assert [r.place for r in got] == list(range(1000))
    before = 0
    for r in got:
        assert r.n_before == before
        before += r.n or 0
    assert placed(rows.limit(0), [F.col("a")], ("n",))[0].count() == 0


# --- manifest -----------------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    chars = None if row.n_chars is None else row.n_chars + more
    values = (row[0], row.source, row.lang, chars, row.text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_levels(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_siblings(levels, at):
    for level in levels[:-1]:
        other = at ^ 1
        yield (level[other], None) if other < at else (None, level[other] if other < len(level) else None)
        at //= 2


def plain_proofs(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append(row)
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    ordered = [sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))) for name in names]
    trees = [plain_levels([plain_leaf(r) for r in rows]) for rows in ordered]
    top = plain_levels([levels[-1][0] for levels in trees])
    for number, (rows, levels) in enumerate(zip(ordered, trees, strict=True)):
        for at, row in enumerate(rows):
            siblings = [*plain_siblings(levels, at), *plain_siblings(top, number)]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            value = plain_leaf(row, more=1 if hit else 0)
            for left, right in siblings:
                value = digest(left or "", value, right or "")
            yield (row[0], plain_leaf(row), levels[-1][0], top[-1][0], siblings, value, value == top[-1][0])


@pytest.mark.parametrize("bits, chunk", [(12, 4096), (1, 3), (2, 5)])
def test_proofs(spark, awkward, monkeypatch, bits, chunk):
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits)
    monkeypatch.setattr(merkle, "CHUNK_LEAVES", chunk)
    some = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    for table in (awkward, some):
        got = [
            (r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.siblings], r.folded_root, r.verified)
            for r in merkle.prove_documents(table).collect()
        ]
        want = list(plain_proofs(table.collect()))
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {r[-1] for r in got} == {True, False}


def test_proofs_of_some_leaves(spark, monkeypatch):
    """Requested leaves alone are proved, chunk by chunk, and what is fetched is no more than they need."""
    monkeypatch.setattr(merkle, "BLOCK_BITS", 3)
    monkeypatch.setattr(merkle, "CHUNK_LEAVES", 11)
    rows = spark.range(100).select(F.col("id").alias("doc_id"), F.expr("IF(id < 83, 'a', 'b')").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    manifest = merkle.build_manifest(rows)
    asked = manifest.leaves.where("doc_id IN (0, 1, 2, 9, 40, 82, 83, 99)")
    proofs = merkle.prove(manifest, asked).withColumn("folded", merkle.folded(F.col("leaf"), F.col("siblings"))).collect()
    assert len(proofs) == 8 and {r.folded for r in proofs} == {manifest.root}
    manifest.drop()


@pytest.mark.parametrize("seed", range(5))
def test_missing_nodes_are_the_least(seed):
    rng = random.Random(seed)
    width = rng.randrange(1, 70)
    at = np.array(sorted(rng.sample(range(width), rng.randrange(1, width + 1))))
    got = {(level, int(i)) for level, places in merkle.missing_nodes(at, width) for i in places}
    want, known, wide, level = set(), set(at.tolist()), width, 0
    while wide > 1:  # a sibling is missing unless a requested leaf lies below it
        want |= {(level, i ^ 1) for i in known if i ^ 1 < wide and i ^ 1 not in known}
        known, wide, level = {i >> 1 for i in known}, -(-wide // 2), level + 1
    assert got == want


def test_manifest_of_nothing_and_of_one(spark, nothing, awkward):
    assert merkle.prove_documents(nothing).count() == 0
    one = merkle.prove_documents(awkward.where("text = 'a'")).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root and one[0].siblings == []


# --- search -------------------------------------------------------------------------------------


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_search(documents, items):
    documents = [(doc_id, Counter(cut(text))) for doc_id, text in documents]
    n_docs, n_words = sum(1 for _, c in documents if c), sum(c.total() for _, c in documents)
    df = Counter(term for _, c in documents for term in c)
    for item_id, text in set(items):
        found = []
        for doc_id, counts in documents:
            score = 0
            for term in set(cut(text)) & counts.keys():
                norm = 100 - 90 + 90 * counts.total() * n_docs // n_words
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += weight * (10**9 * counts[term] // (1000 * counts[term] + 8 * norm))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, no_id, doc_id) in enumerate(sorted(found)[:10], 1):
            yield item_id, rank, None if no_id else doc_id, -score


@pytest.mark.parametrize("tree, leaf, batch, maxima", [(8192, 48, 1 << 24, 1 << 23), (64, 2, 1 << 24, 1 << 23), (300, 5, 200, 1 << 23), (500, 5, 1 << 24, 1 << 14)])
def test_search(spark, monkeypatch, tree, leaf, batch, maxima):
    monkeypatch.setattr(lexical, "TREE_MAXIMA", maxima)
    monkeypatch.setattr(lexical, "TREE_DOCUMENTS", tree)
    monkeypatch.setattr(lexical, "LEAF_DOCUMENTS", leaf)
    monkeypatch.setattr(lexical, "BATCH_BYTES", batch)
    rng = random.Random(7)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(20_000)]
    documents = [(i, " ".join(rng.choices(words, k=int(rng.paretovariate(0.9)) % 200))) for i in range(900)]
    documents += [(2000 + i, "Same w1 words w2 in MANY copies w2") for i in range(150)]
    documents += [(None, "same w7"), (77, "w7 same"), (77, "w7 same"), (3000, None), (3001, ""), (3002, "É w3-w4_w5 é"), (3003, "w1 " * 500_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 30)))) for i in range(30)]
    items += [(40, None), (41, ""), (42, "no such terms"), (43, "same copies"), (44, "é W5"), (44, "é W5"), (None, "w7 SAME")]
    frame = spark.createDataFrame([(*row, 0) for row in documents], "doc_id BIGINT, text STRING, Doc_Id INT")
    found = lexical.search_documents(frame.repartition(5), spark.createDataFrame(items, "item_id BIGINT, text STRING"))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, plain_search(documents, items)))


def test_search_of_nothing(spark, nothing, awkward):
    items = spark.createDataFrame([(1, "a")], "item_id BIGINT, text STRING")
    assert lexical.search_documents(nothing, items).count() == 0
    assert lexical.search_documents(awkward, items.limit(0)).count() == 0
    assert {r.doc_id for r in lexical.search_documents(awkward, items).collect()} == {1, -7}


def test_maxima_of_a_tree_are_bounded(monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(lexical, "TREE_MAXIMA", 200_000)
    ranks = [np.unique(rng.integers(0, 20_000, 30)) for _ in range(2000)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in ranks])])
    tree = lexical.Tree(list(range(2000)), np.full(2000, 100), starts, np.concatenate(ranks), np.ones(starts[-1], np.int64))
    assert tree.most.size <= 300_000


def test_branches_are_left_out():
    """An item of one rare term scores the few documents around it alone."""
    rng = np.random.default_rng(1)
    n = 4000
    ranks = [np.sort(rng.choice(40, 12, replace=False)) + 1 for _ in range(n)]
    for i in (5, 1700):
        ranks[i] = np.append(ranks[i], 99)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in ranks])])
    tree = lexical.Tree(list(range(n)), np.full(n, 100), starts, np.concatenate(ranks), np.ones(starts[-1], np.int64))
    best = []
    assert 0 < tree.search(np.array([99]), np.array([5000]), best) < n // 10
    assert [entry[-1] for entry in best] == [5, 1700]


# --- mixing -------------------------------------------------------------------------------------


def plain_targets(sizes, weights, budget):
    """Shares by weight, cut at twice the size, the rest shared again."""
    full = set()
    while True:
        free = sum(weights[s] for s in sizes if s not in full)
        left = budget - sum(2 * sizes[s] for s in full)
        share = {s: 2 * sizes[s] if s in full else left * weights[s] / free for s in sizes}
        above = {s for s in sizes if s not in full and share[s] > 2 * sizes[s]}
        if not above:
            return share
        full |= above


def code_points(source):
    return (source is None, source or "")


@pytest.mark.parametrize("seed", range(3))
def test_mix(spark, seed):
    rng = random.Random(seed)
    sources = [None, "", "a", "B", "é", "\U0001f600", "￿", "hot"]
    rows = [(i, " ".join("w" * rng.randrange(0, 60)), sources[min(rng.randrange(14), 7)]) for i in range(400)]
    rows += [(7, "x y", "a"), (7, "x y", "a"), (None, "p q", "a"), (None, None, "tiny"), (900, "z " * 50_000, "hot")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id BIGINT, text STRING, source STRING, SIZE INT")
    uses = curriculum.mix(frame.repartition(7)).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=code_points))}
    target = plain_targets(sizes, weights, 1.5 * sum(sizes.values()))
    taken, of_row = Counter(), Counter()
    for use in uses:
        assert use.source_size == sizes[use.source] and math.isclose(use.target, target[use.source], abs_tol=1e-6)
        taken[use.source] += use.words
        of_row[use.row] += use.words
        assert of_row[use.row] <= 2 * use.size
    assert len(of_row) == len(rows)
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in sizes)
    # the order of training is that of positions, and reruns agree
    positions = [use.position for use in uses if use.position is not None]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
    assert [use.position is None for use in uses] == sorted(use.position is None for use in uses)
    again = curriculum.taken_words(frame.repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, curriculum.taken_words(frame).collect()))
    assert sum(r.taken for r in again) == sum(taken.values())


def test_positions_follow_the_schedules(spark):
    """By any time a source has given what its weights integrate to."""
    ramp = (((0.0, 0.0), (0.25, 4.0), (0.5, 0.0), (0.75, 0.0), (1.0, 8.0)), ((0.0, 3.0), (1.0, 0.0)))
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("IF(id % 2 = 0, 'a', 'b')").alias("source"), F.lit("one two three").alias("text"))
    uses = [u for u in curriculum.mix(frame, ramp, 0.5).collect() if u.words]
    for number, source in enumerate("ab"):
        of_source = [u for u in uses if u.source == source]
        whole = sum(u.words for u in of_source)
        for time in (0.1, 0.25, 0.4, 0.6, 0.8, 0.95):
            demand = 0.0
            for start, end, low, high, _ in curriculum.segments(ramp[number]):
                length = max(0.0, min(end, time) - start)
                demand += length * (low + (high - low) * length / (end - start) / 2)
            given = sum(u.words for u in of_source if u.position <= time)
            assert abs(given / whole - demand / curriculum.integral(ramp[number])) < 0.01


def test_mix_of_nothing_and_of_empty_texts(spark, nothing, awkward):
    assert curriculum.mix(nothing).count() == 0
    empty = curriculum.taken_words(awkward.withColumn("text", F.lit(None).cast("string"))).collect()
    assert len(empty) == 10 and {(r.size, r.taken, r.target) for r in empty} == {(0, 0, 0.0)}
    rows = curriculum.taken_words(awkward).collect()
    assert len(rows) == 10 and max(r.size for r in rows) == 400_000


@pytest.mark.parametrize("bad", [((0.0, 1.0),), ((0.0, 1.0), (0.5, 1.0)), ((0.0, -1.0), (1.0, 2.0)), ((0.0, 0.0), (1.0, 0.0))])
def test_bad_schedules(bad):
    with pytest.raises(ValueError):
        curriculum.segments(bad)
