"""Components, SimHash search and embeddings against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from corpusflow.llm import embeddings, shingles, simhash
from corpusflow.llm.components import components


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000 + i, 1001 + i) for i in range(70)]  # a chain
    links += [(2000, 2001 + i) for i in range(300)]  # a hub
    links += [(5, 5), (7, 3), (3, 7)]
    rows = [*links, (None, 9), (9, None)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a BIGINT, b BIGINT")).collect()}
    want = union_find({n for link in links for n in link}, links)
    assert got == {n: root for n, root in want.items() if n != root}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c d e f g", "x y z\x1cq w é É", "w " * 300_000])
def test_fingerprint(text):
    if text and len(text) > 1000:
        assert simhash.fingerprint(text) == plain_fingerprint("w w w w")
    else:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_links_are_exact(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(1500)]
    for value in values[:300]:
        for flips in (1, 2, 2, 3):
            other = value
            for bit in rng.sample(range(64), flips):
                other ^= 1 << bit
            values.append(other)
    # all values around one point: every pair within two bits
    values += [values[0] ^ (1 << b) for b in range(64)] + [0, 2**64 - 1]
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64)
    df = spark.createDataFrame([(int(v),) for v in signed], "fingerprint BIGINT")
    got = {tuple(sorted(row)) for row in simhash.near_links(df).collect()}
    array, want = np.array(values, np.uint64), set()
    for i, value in enumerate(array):
        near = np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ value) <= 2) + i + 1
        want.update(tuple(sorted((int(signed[i]), int(signed[j])))) for j in near)
    assert got == want


def test_groups(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base), (3, base), (None, base), (9, base.replace("w7 ", "q7 ", 1)), (1, None), (2, ""), (4, "other text here"), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = simhash.near_duplicate_groups(df).collect()
    prints = [plain_fingerprint(text) for _, text in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = union_find(range(len(rows)), links)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(roots[i], []).append(doc_id)
    want = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for d in groups[roots[i]] if d is not None]
        want.append((doc_id, prints[i], min(ids) if ids else None))
    assert sorted(map(repr, want)) == sorted(repr((r[0], r[1] % 2**64, r[2])) for r in got)


def test_one_of_each_group_stays(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base, "a", 1), (3, base, "b", 2), (3, base, "c", 3), (None, base, "d", 4), (1, None, "e", 5), (2, "", "f", 6), (None, "alone here now", "g", 7)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, TEXT STRING, fingerprint INT")
    left = simhash.drop_near_duplicates(df)
    assert left.columns == df.columns
    got = sorted((tuple(r)[:2] for r in left.collect()), key=repr)
    assert got == sorted([(3, base), (1, None), (None, "alone here now")], key=repr)
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_near_copies_go(spark):
    rng = random.Random(31)

    def shingles(words):
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    def words_of(n):
        return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n)]

    rows, near, far = [], set(), set()
    for i in range(80):
        base = words_of(300)
        rows.append((i, " ".join(base)))
        for k, edits in enumerate((2, 4, 5, 6, 9, 14)):
            copy = list(base)
            for at in rng.sample(range(300), edits):
                copy[at] = words_of(1)[0] + "z"
            a, b = shingles(base), shingles(copy)
            doc_id = 1000 + 10 * i + k
            (near if len(a & b) / len(a | b) >= 0.8 else far).add(doc_id)
            rows.append((doc_id, " ".join(copy)))
    rng.shuffle(rows)
    left = {r[0] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert len(near) > 250 and set(range(80)) <= left and not near & left
    texts = {i: shingles(text.split()) for i, text in rows}
    assert all(i in left or any(len(texts[i] & texts[j]) / len(texts[i] | texts[j]) >= 0.8 for j in texts if j < i) for i in far)


def test_of_each_group_of_fingerprints_one_stays_in_the_pipeline(spark):
    rng = random.Random(52)

    def words_of(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    # what repeats decides the fingerprint, but not the set of shingles; 3 shares a fingerprint with nothing
    often = "one two three " * 400
    rows = [(i, often + " ".join(words_of(12))) for i in (6, 2, 9)] + [(3, " ".join(words_of(300))), (None, None), (4, " \t"), (5, often)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicate_groups(df).collect()}
    assert groups == {2: 2, 5: 2, 6: 2, 9: 2, 3: 3, 4: 4, None: 4}
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [2, 3, 4]


def test_family_of_different_texts_takes_few_rounds(spark, monkeypatch):
    rng = random.Random(44)
    shared = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = [" ".join(shared + [f"x{rng.randrange(10**6)}" for _ in range(120)]) for _ in range(60)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(1000 + i, f"{text} more") for i, text in enumerate(texts)]
    rounds = []
    staged_at = shingles.staged_at
    monkeypatch.setattr(shingles, "staged_at", lambda df, label: (rounds.append(label), staged_at(df, label))[1])
    left = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert sorted(r.doc_id for r in left.collect()) == list(range(60))
    assert rounds.count("leaders") <= 4


def test_no_documents(spark):
    assert simhash.near_duplicate_groups(spark.createDataFrame([], "doc_id BIGINT, text STRING")).count() == 0


def brute_vectors(rows):
    fine = [
        e is not None and label is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e)
        for _, e, label in rows
    ]
    n = len(rows)
    units = [np.array(e, float) / np.linalg.norm(np.array(e, float)) if ok else None for (_, e, _), ok in zip(rows, fine)]
    links = [
        (i, j) for i in range(n) for j in range(i)
        if fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93
    ]
    roots = union_find(range(n), links)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if roots[j] == roots[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((vec_id, sum(i in link for link in links), component, vec_id is not None and vec_id == component))
    return out


@pytest.mark.parametrize("block", [1024, 8])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = []
    for centre in rng.standard_normal((12, 16)):
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows) * 7 % 1000, (centre + 0.12 * rng.standard_normal(16)).astype(np.float32).tolist(), int(rng.integers(0, 2))))
    hot = rng.standard_normal(16)
    rows += [(2000 + i, (hot + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist(), 1) for i in range(60)]
    rows += [(3000 + i, rows[0][1], rows[0][2]) for i in range(5)]  # equal vectors
    rows += [(1, rows[0][1], None), (2, None, 1), (3, [0.0] * 16, 1), (4, [float("nan")] * 16, 1), (6, [float("inf")] + [1.0] * 15, 1)]
    rows += [(7, [None] + [1.0] * 15, 1), (8, [], 1), (9, [1.0, 2.0], 1), (None, rows[0][1], rows[0][2]), (rows[1][0], rows[1][1], rows[1][2])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    df = df.select("*", F.lit(0).alias("node"), F.lit("x").alias("Label"))
    got = embeddings.near_duplicate_vectors(df).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_vectors(rows)))


def test_no_vectors(spark):
    assert embeddings.near_duplicate_vectors(spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")).count() == 0


def test_recall_at_the_threshold():
    """Pairs at a cosine of just 0.93 meet in some table."""
    rng = np.random.default_rng(2)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((3000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    planes = embeddings._planes(64)
    signs = [(x @ planes > 0).reshape(-1, embeddings.TABLES, embeddings.BITS) for x in (a, b)]
    assert (signs[0] == signs[1]).all(axis=2).any(axis=1).mean() >= 0.98
