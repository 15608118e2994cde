"""Step plan, losses, choosing among scores, and run logs."""

import math
import random
from datetime import datetime, timedelta

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.ordering import with_id_order
from corpusflow.operators.runlog import throughput
from corpusflow.operators.scores import (
    argmax,
    bigram_counts,
    draw,
    masked_loss,
    score_tokens,
    softmax,
    top_p,
    uniform,
    validation_summary,
)
from corpusflow.operators.stream import token_offsets
from corpusflow.operators.windows import batch
from corpusflow.plans.steps import batch_count, order_manifest, step_documents, step_plan, token_budget
from corpusflow.sources.config import StepConfig


def steps(**change):
    base = dict(learning_rate=3e-4, min_lr=6e-5, warmup_ratio=0.01, max_steps=1962, accumulate_grad_batches=4)
    return StepConfig(**{**base, **change})


def rate(step, config):
    if config.scheduler == "none":
        return config.learning_rate
    warmup, floor = round(config.warmup_ratio * config.max_steps), config.min_lr / config.learning_rate
    if step < warmup:
        return config.learning_rate * step / warmup
    if config.max_steps <= warmup:
        return config.learning_rate * floor
    done = min(1.0, (step - warmup) / (config.max_steps - warmup))
    return config.learning_rate * (floor + (1 - floor) * 0.5 * (1 + math.cos(math.pi * done)))


@pytest.mark.parametrize(
    "config",
    [steps(), steps(scheduler="none"), steps(warmup_ratio=0), steps(warmup_ratio=1, max_steps=50), steps(max_steps=1)],
)
def test_learning_rate(spark, config):
    rows = step_plan(spark, 1000, 8, 2, config).orderBy("step").collect()
    assert len(rows) == config.max_steps
    assert all(abs(row.lr - rate(row.step, config)) < 1e-15 for row in rows)


@pytest.mark.parametrize("windows, drop_last", [(23, True), (23, False), (24, True), (3, False)])
def test_step_plan_walks_through_all_batches(spark, windows, drop_last):
    batch_size, accumulate = 3, 2
    rows = step_plan(spark, windows, 8, batch_size, steps(max_steps=11, accumulate_grad_batches=accumulate), drop_last)
    batches = batch_count(windows, batch_size, drop_last)
    sizes = [min(batch_size, windows - b * batch_size) for b in range(batches)]
    want, epoch, at = [], 0, 0
    for step in range(11):
        last = min(at + accumulate, batches) - 1
        n = sum(sizes[at : last + 1])
        want.append((step, epoch, at, last, n, n * 8))
        at, epoch = (0, epoch + 1) if last == batches - 1 else (last + 1, epoch)
    assert [tuple(r)[:6] for r in rows.orderBy("step").collect()] == want


def test_no_batch_is_an_error(spark):
    with pytest.raises(ValueError):
        step_plan(spark, 2, 8, 3, steps(), drop_last=True)


def test_budget_of_the_sample_run(spark):
    row = token_budget(spark, {"train": 450_000_000}, 1024, 1024, 56, 4, ["train"]).collect()[0]
    assert (row.tokens_per_batch, row.tokens_per_step, row.effective_batch_size) == (57_344, 229_376, 224)
    assert row.steps_per_pass == math.ceil(((450_000_000 - 1025) // 1024 + 1) // 56 / 4)


def test_manifest_names_the_documents_of_each_step(spark):
    rng = random.Random(3)
    lengths = [rng.choice([1, 2, 5, 60]) for _ in range(40)]
    df = spark.createDataFrame([("train", i, n) for i, n in enumerate(lengths)], "split STRING, doc_id BIGINT, token_len INT")
    stream = token_offsets(with_id_order(df), tokens_per_bucket=30)
    block, stride, batch_size, accumulate = 8, 6, 2, 3
    owner = [i for i, n in enumerate(lengths) for _ in range(n)]
    windows = (len(owner) - block - 1) // stride + 1
    usable = windows // batch_size * batch_size
    read = {}
    for w in range(usable):
        for token in range(w * stride, w * stride + block + 1):
            key = (w // (batch_size * accumulate), owner[token])
            read[key] = read.get(key, 0) + 1
    documents = step_documents(stream, "train", block, stride, batch_size, accumulate)
    assert {(r.step_in_pass, r.doc_id): r.n_tokens for r in documents.collect()} == read
    plan = step_plan(spark, windows, block, batch_size, steps(max_steps=40, accumulate_grad_batches=accumulate))
    per_pass = max(step for step, _ in read) + 1
    for row in order_manifest(documents, plan, accumulate).collect():
        mine = {doc: n for (step, doc), n in read.items() if step == row.step % per_pass}
        assert (row.n_documents, row.min_doc_id, row.max_doc_id, row.tokens_read) == (
            len(mine), min(mine), max(mine), sum(mine.values()),
        )


# losses


def test_masked_loss_and_summary(spark):
    rows = [(0, 5, -1.0), (0, 6, -3.0), (0, -100, -9.0), (1, 5, -0.5), (2, -100, -1.0)]
    losses = masked_loss(spark.createDataFrame(rows, "batch_id BIGINT, target INT, logp DOUBLE"))
    got = {r.batch_id: (r.n_targets, r.loss, r.perplexity) for r in losses.collect()}
    assert got[0] == (2, 2.0, pytest.approx(math.exp(2)))
    assert got[1] == (1, 0.5, pytest.approx(math.exp(0.5)))
    assert got[2] == (0, None, None)
    summary = validation_summary(losses).collect()[0]
    assert (summary.batches, summary.val_loss) == (2, 1.25)
    assert summary.val_ppl == pytest.approx((math.exp(2) + math.exp(0.5)) / 2) != pytest.approx(math.exp(1.25))
    weighted = validation_summary(losses.withColumn("n", F.col("batch_id") + 1), F.col("n")).collect()[0]
    assert weighted.val_loss == pytest.approx((2.0 + 2 * 0.5) / 3)


def test_bigram_scores(spark):
    encoded = spark.createDataFrame([([1, 2, 2, 3],), ([1, 2],), ([4],)], "ids ARRAY<INT>")
    counts = bigram_counts(encoded)
    assert {(r.left_id, r.right_id): r.n for r in counts.collect()} == {(1, 2): 2, (2, 2): 1, (2, 3): 1}
    windows = spark.createDataFrame([(0, [1, 1, 9, 2, 2], [2, 2, 9, 9, -100])], "batch_id BIGINT, x ARRAY<INT>, y ARRAY<INT>")
    rows = score_tokens(windows, counts, vocab_size=10).collect()
    got = sorted((r.target, r.weight, r.logp and round(math.exp(r.logp), 9)) for r in rows)
    assert got == [(-100, 1, None), (2, 2, round(3 / 12, 9)), (9, 1, round(1 / 12, 9)), (9, 1, round(1 / 10, 9))]
    loss = masked_loss(score_tokens(windows, counts, 10)).collect()[0]
    assert loss.n_targets == 4
    assert loss.loss == pytest.approx(-(2 * math.log(3 / 12) + math.log(1 / 12) + math.log(1 / 10)) / 4)


# choosing


SCORES = [(0, 1, 2.0), (0, 2, 1.0), (0, 3, 1.0), (0, 4, -3.0), (1, 7, 0.5), (2, 5, 100.0), (2, 6, 0.0)]


def scores(spark):
    return spark.createDataFrame(SCORES, "group_id INT, item_id INT, score DOUBLE")


def shares(rows, temperature):
    scale = temperature if temperature > 0 else 1.0
    top = max(s for _, s in rows)
    weights = {item: math.exp((s - top) / scale) for item, s in rows}
    total = sum(weights.values())
    return {item: w / total for item, w in weights.items()}


def by_group(rows):
    out = {}
    for group, item, value in rows:
        out.setdefault(group, []).append((item, value))
    return out


@pytest.mark.parametrize("temperature", [1.0, 0.5, 3.0, 0.0, -1.0])
def test_softmax(spark, temperature):
    got = by_group((r.group_id, r.item_id, r.p) for r in softmax(scores(spark), temperature).collect())
    for group, rows in by_group(SCORES).items():
        assert dict(got[group]) == pytest.approx(shares(rows, temperature))


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.7, 0.95, 1.0, 2.0])
def test_top_p_keeps_the_item_that_crosses(spark, threshold):
    got = by_group((r.group_id, r.item_id, r.p) for r in top_p(softmax(scores(spark)), threshold).collect())
    for group, rows in by_group(SCORES).items():
        probs = sorted(shares(rows, 1).items(), key=lambda kv: (-kv[1], kv[0]))
        kept, before = [], 0.0
        for place, (item, p) in enumerate(probs):
            if threshold >= 1 or place == 0 or before <= threshold:
                kept.append((item, p))
            before += p
        total = sum(p for _, p in kept)
        assert dict(got[group]) == pytest.approx({item: p / total for item, p in kept})


def test_argmax_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([(0, 3, 1.0), (0, 2, 1.0), (0, 9, 0.5), (1, 4, -1.0)], "group_id INT, item_id INT, score DOUBLE")
    assert {r.group_id: r.item_id for r in argmax(df).collect()} == {0: 2, 1: 4}


def test_draw_is_repeatable_and_follows_the_shares(spark):
    items = F.expr("stack(3, 1, 0.5D, 2, 0.3D, 3, 0.2D)").alias("item_id", "p")
    probs = spark.range(4000).select(F.col("id").alias("group_id"), items)
    first = {r.group_id: r.item_id for r in draw(probs, 7).collect()}
    assert first == {r.group_id: r.item_id for r in draw(probs.repartition(5), 7).collect()}
    assert len(first) == 4000
    for item, share in ((1, 0.5), (2, 0.3), (3, 0.2)):
        assert abs(list(first.values()).count(item) / 4000 - share) < 0.04
    bounds = spark.range(1000).select(uniform(1, "id").alias("u")).agg(F.min("u"), F.max("u")).first()
    assert 0 <= bounds[0] < 0.01 and 0.99 < bounds[1] < 1


# run logs


def monitor(log, every_n, count):
    """The step-by-step form: ``log`` is one run in step order."""
    out, clock, total, fresh = [], None, 0, 0
    so_far = 0
    for step, ts, n in log:
        so_far += n
        fresh += n
        if (step + 1) % every_n:
            continue
        if clock is not None and ts > clock:
            elapsed = (ts - clock).total_seconds()
            total += n
            emitted = (n, total) if count == "sampled" else (fresh, so_far)
            out.append((step, emitted[0] / elapsed, emitted[1]))
        clock, fresh = ts, 0
    return out


@pytest.mark.parametrize("count", ["all", "sampled"])
@pytest.mark.parametrize("every_n", [1, 3, 5])
@pytest.mark.parametrize("slice_steps", [1, 7, 1_000_000])
def test_throughput_equals_the_monitor(spark, count, every_n, slice_steps):
    rng = random.Random(every_n)
    runs = {}
    for run in range(4):
        now, rows = datetime(2024, 1, 1), []
        for step in range(0, 60, rng.choice([1, 2])):
            now += timedelta(seconds=rng.choice([0, 1, 2, 2.5]))  # 0: the clock stands still
            rows.append((step, now, rng.randint(1, 100)))
        runs[run] = rows
    df = spark.createDataFrame(
        [(run, *row) for run, rows in runs.items() for row in rows], "run_id INT, step BIGINT, ts TIMESTAMP, n_tokens BIGINT"
    )
    got = {}
    for r in throughput(df, every_n, count, slice_steps).orderBy("run_id", "step").collect():
        got.setdefault(r.run_id, []).append((r.step, r.tokens_per_sec, r.tokens_processed))
    for run, rows in runs.items():
        want = monitor(rows, every_n, count)
        assert [g[0] for g in got[run]] == [w[0] for w in want]
        assert [g[2] for g in got[run]] == [w[2] for w in want]
        assert [g[1] for g in got[run]] == pytest.approx([w[1] for w in want])


def test_throughput_arguments(spark):
    df = spark.createDataFrame([], "run_id INT, step BIGINT, ts TIMESTAMP, n_tokens BIGINT")
    with pytest.raises(ValueError):
        throughput(df, 0)
    with pytest.raises(ValueError):
        throughput(df, 1, "some")


def test_budget_counts_the_batches_there_are(spark):
    totals = {"train": 1000, "validation": 1000}
    budget = {row["split"]: row["batches"] for row in token_budget(spark, totals, 16, 16, 7, 2, ["train"]).collect()}
    counts = {split: (n - 17) // 16 + 1 for split, n in totals.items()}
    windows = spark.range(counts["train"]).selectExpr("'train' AS split", "id AS window_id").unionByName(
        spark.range(counts["validation"]).selectExpr("'validation' AS split", "id AS window_id")
    )
    rows = batch(windows, 7, counts, ["train"]).select("split", "batch_id").distinct().collect()
    assert budget == {split: sum(row["split"] == split for row in rows) for split in totals}
    assert budget["validation"] == budget["train"] + 1


@pytest.mark.parametrize("block, stride, per_batch, accumulate, drop_last", [(8, 8, 2, 3, True), (8, 3, 3, 2, False), (5, 1, 4, 1, True), (7, 7, 1, 1, False), (16, 5, 50, 9, False)])
def test_documents_of_steps_equal_counting_every_window(spark, block, stride, per_batch, accumulate, drop_last):
    lengths = [1, 2, 40, 3, 300, 1, 1, 17, 9, 8, 60]
    rows = [(i, [i] * n, n) for i, n in enumerate(lengths)]
    df = with_id_order(spark.createDataFrame(rows, "doc_id BIGINT, ids ARRAY<INT>, token_len INT").withColumn("split", F.lit("train")))
    got = step_documents(token_offsets(df, tokens_per_bucket=100), "train", block, stride, per_batch, accumulate, drop_last)
    tokens = [i for i, n in enumerate(lengths) for _ in range(n)]
    windows = (len(tokens) - block - 1) // stride + 1
    usable = batch_count(windows, per_batch, drop_last) * per_batch
    want = Counter()
    for w in range(min(windows, usable)):
        for doc_id in tokens[w * stride : w * stride + block + 1]:
            want[w // (per_batch * accumulate), doc_id] += 1
    assert {(r.step_in_pass, r.doc_id): r.n_tokens for r in got.collect()} == want
    # one row a document and step, however many windows there are
    assert "window_id" not in got._jdf.queryExecution().optimizedPlan().toString()
