"""Classifiers by held-out accuracy, the pipeline by planted cases, and the queries against their SQL."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from corpusflow.llm import quality, toxicity
from corpusflow.llm.labelled import fit_logistic, labelled_sample, sigmoid
from corpusflow.llm.queries import QUERIES
from corpusflow.llm.sql import ORACLE_SQL

SMALL, MIDDLE = f"{TESTDATA}/sf0.001", f"{TESTDATA}/sf0.01"
DOCS = "doc_id BIGINT, text STRING"


@pytest.fixture(scope="module")
def tables(spark):
    return {name: spark.read.parquet(f"{MIDDLE}/{name}.parquet") for name in ("documents", "labels")}


def scored(df, labels, label):
    rows = df.join(labels, "doc_id").select("held_out", "score", label).collect()
    return [(r["held_out"], r["score"], r[label]) for r in rows]


def test_held_out_rows():
    assert zlib.crc32(b"12") % 4 == 1


def test_sample_is_bounded_and_clean(spark, tables):
    labels = tables["labels"].unionByName(spark.createDataFrame([(0, 0, 1), (None, 1, 1)], "doc_id BIGINT, quality INT, toxic INT"))
    documents = tables["documents"].unionByName(tables["documents"].where("doc_id < 50"))
    sample, counts = labelled_sample(documents, labels, "quality", 20, 15)
    rows = sample.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) <= 55
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in rows)
    assert sum(r["label"] == 1 for r in rows) == 20 and sum(r["label"] == 0 for r in rows) == 20
    assert not any(r["doc_id"] == 0 and r["label"] is not None for r in rows)  # it has both labels
    assert counts[1] > counts[0] > 0


def test_logistic_fit():
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(4000), rng.standard_normal((4000, 2))])
    y = (rng.random(4000) < sigmoid(x @ np.array([0.5, 2.0, -1.0]))).astype(float)
    assert np.allclose(fit_logistic(x, y, np.ones(4000), 1e-3), [0.5, 2.0, -1.0], atol=0.25)


def test_quality_held_out(spark, tables):
    model = quality.fit_quality(tables["documents"], tables["labels"])
    held = [(s, y) for out, s, y in scored(quality.score_quality(tables["documents"], model), tables["labels"], "quality") if out]
    assert np.mean([(s >= 0.7) == bool(y) for s, y in held]) >= 0.93
    rows = [(1, None), (2, ""), (None, "a"), (3, "word " * 200_000), (3, "x")]
    df = spark.createDataFrame([(*r, "b", 0.5) for r in rows], "doc_id BIGINT, text STRING, TEXT STRING, score DOUBLE")
    got = quality.score_quality(df, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]


def test_scores_without_labels(spark, tables):
    none = tables["labels"].limit(0)
    docs = spark.createDataFrame([(1, "a"), (2, None)], DOCS)
    for fit, score, label in ((quality.fit_quality, quality.score_quality, "quality"), (toxicity.fit_toxicity, toxicity.score_toxicity, "toxic")):
        assert {r["score"] for r in score(docs, fit(docs, none, label)).collect()} == {0.5}
        one_sided = spark.createDataFrame([(1, 1, 1)], "doc_id BIGINT, quality INT, toxic INT")
        assert len({r["score"] for r in score(docs, fit(docs, one_sided, label)).collect()}) == 1
        assert score(docs.limit(0), fit(docs.limit(0), none, label)).count() == 0


def test_compression_tells_what_the_dictionaries_hold():
    pairs = ((b"the quick brown fox jumps over the lazy dog " * 3, b"BUY NOW!!! cheap pills $$$ click here " * 3),) * 2
    good, bad, empty = quality.features(["the quick brown fox", "BUY NOW!!! cheap pills $$$", ""], pairs)
    assert good[0] > 0 > bad[0] and empty[0] == 0


def plain_score(model, text):
    """The linear classifier straight from the features of a text."""
    names = toxicity.features(toxicity.tokens(text))
    weights = dict(model.words)
    for start, listed in model.starts.items():
        weights.update({f"^{start}/{share}" if share else f"^{start}": weight for share, weight in listed})
    fired = np.array(toxicity.patterns(text, toxicity.tokens(text))) > np.array(model.pattern_cuts)
    return float(sigmoid(np.array(model.bias + sum(weights.get(n, 0) for n in names) + fired @ np.array(model.pattern_weights))))


def test_toxicity_held_out(spark):
    documents, labels = (spark.read.parquet(f"{TESTDATA}/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit_toxicity(documents, labels)
    rows = scored(toxicity.score_toxicity(documents, model), labels, "toxic")
    held = [(s, y) for out, s, y in rows if out]
    assert np.mean([(s >= 0.3) == bool(y) for s, y in held]) >= 0.97
    assert np.mean([s >= 0.3 for s, y in held if y == 0]) <= 0.01
    texts = [r["text"] for r in documents.select("text").limit(40).collect()] + ["", "A", "é" * 9]
    assert np.allclose([model.score(t) for t in texts], [plain_score(model, t) for t in texts])
    left = toxicity.drop_toxic(spark.createDataFrame([(1, None, "x", 2.0)], "doc_id BIGINT, text STRING, TEXT STRING, score DOUBLE"), model, 0.3)
    assert left.columns == ["doc_id", "text", "TEXT", "score"] and left.count() == 1


def test_label_model_shares_the_weight_of_voters_that_agree():
    rng = np.random.default_rng(1)
    y = rng.random(3000) < 0.3
    one = (y & (rng.random(3000) < 0.8)) | (~y & (rng.random(3000) < 0.05))
    other = (y & (rng.random(3000) < 0.6)) | (~y & (rng.random(3000) < 0.02))
    votes = np.column_stack([one, one, one, other, ~(one | other)]).astype(float)
    labels = np.where(rng.random(3000) < 0.2, y, -1)
    model = toxicity.fit_label_model(votes, labels, 0.3)
    assert model.weight[:3].sum() < 1.3 and model.weight[3] > 0.8
    assert np.mean((model.posterior(votes) > 0.5) == y) > 0.9


# --- pipeline -------------------------------------------------------------------------------------


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_planted_cases(spark, tmp_path):
    rng = random.Random(12)
    insults = ["grobnak", "vlistup", "dremzok", "plaxine"]

    def toxic():
        words = prose(rng, 80).split()
        for i in range(5, 80, 9):
            words[i] = rng.choice(insults)
        return " ".join(words)

    clean = [(i, prose(rng, 90)) for i in range(300)]
    bad = [(1000 + i, toxic()) for i in range(120)]
    passage, item = prose(rng, 70), prose(rng, 40)
    repeats = [(2000 + i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(15)]
    copies = [(3000 + i, clean[7][1]) for i in range(5)]
    leaks = [(4000 + i, f"{prose(rng, 30)} {item[3:]} {prose(rng, 30)}") for i in range(1)] + [(5000, f"{prose(rng, 30)} {' '.join(item.split()[:14])} {prose(rng, 30)}")]
    rows = clean + bad + repeats + copies + leaks + [(6000, None), (None, ""), (6001, prose(rng, 20_000)), clean[9]]
    rng.shuffle(rows)
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING"
    folder = str(tmp_path)
    spark.createDataFrame([(*r, "en", "src0", len(r[1] or ""), "s") for r in rows], schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in clean[:200]] + [(i, 1, 1) for i, _ in bad[:80]]
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")

    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = docs.collect()
    ids = {name: [r["doc_id"] for r in rows] for name, rows in seen.items()}
    assert not set(ids["toxicity"]) & {i for i, _ in bad}
    assert set(ids["toxicity"]) >= {i for i, _ in rows} - {i for i, _ in bad}
    after = {r["doc_id"]: r["text"] for r in seen["line_dedup"]}
    middle = " ".join(passage.split()[14:-14])
    assert sum(middle in (text or "") for text in after.values()) == 1
    assert not set(after) & {i for i, _ in copies}
    assert all(after[i] == text for i, text in clean)
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"] if r["text"])
    assert ids["near_dedup"].count(9) == 1 and set(ids["near_dedup"]) >= {i for i, _ in clean}
    assert not {4000, 5000} & set(ids["decontamination"]) and set(ids["decontamination"]) >= {i for i, _ in clean}
    packed = {}
    for piece in seen["packing"]:
        packed[piece["doc_id"]] = packed.get(piece["doc_id"], 0) + piece["length"]
    assert all(packed[piece["doc_id"]] == piece["doc_tokens"] for piece in seen["packing"])
    assert set(packed) == set(ids["decontamination"])


def test_run_is_the_stages(spark):
    pieces = corpus_pipeline.run(spark, SMALL)
    assert pieces.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert 0 < pieces.select("doc_id").distinct().count() < 200


def test_empty_documents_pass_all_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


# --- queries --------------------------------------------------------------------------------------


def test_registration():
    names = {name.split("_")[0] for name in QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, SMALL)
    table, key = ("embeddings", "vec_id") if name.startswith("op4") else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()}
    got = {r[0] for r in rows.select(F.col(key)).collect()}
    assert got == ids if not name.startswith("op7") else got <= ids
