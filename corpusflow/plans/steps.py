"""From windows to optimizer steps: token budget, step plan, and which documents a step reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.stream import TokenStream
from corpusflow.operators.windows import window_count
from corpusflow.sources.config import StepConfig


def batch_count(windows: int, batch_size: int, drop_last: bool) -> int:
    return windows // batch_size if drop_last else -(-windows // batch_size)


def token_budget(
    spark: SparkSession,
    totals: dict[str, int],
    block_size: int,
    stride: int,
    batch_size: int,
    accumulate: int,
    drop_last_splits: Iterable[str] = (),
) -> DataFrame:
    """Per split: windows, batches and steps of one pass, and tokens per batch and per step.

    As in :func:`corpusflow.operators.windows.batch`, an incomplete last batch is dropped in ``drop_last_splits`` only.
    """
    dropping = set(drop_last_splits)
    rows = []
    for split, n_tokens in sorted(totals.items()):
        windows = window_count(n_tokens, block_size, stride)
        batches = batch_count(windows, batch_size, split in dropping)
        rows.append(
            (
                split,
                n_tokens,
                windows,
                batches,
                -(-batches // accumulate),
                batch_size * accumulate,
                batch_size * block_size,
                batch_size * block_size * accumulate,
            )
        )
    return spark.createDataFrame(
        rows,
        "split STRING, n_tokens BIGINT, windows BIGINT, batches BIGINT, steps_per_pass BIGINT, "
        "effective_batch_size BIGINT, tokens_per_batch BIGINT, tokens_per_step BIGINT",
    )


def learning_rate(step: Column, config: StepConfig) -> Column:
    """Linear warm-up from 0, then a cosine down to ``min_lr``; constant without a scheduler."""
    top = F.lit(float(config.learning_rate))
    if config.scheduler == "none":
        return top
    warmup = round(config.warmup_ratio * config.max_steps)
    floor = config.min_lr / config.learning_rate
    if config.max_steps <= warmup:
        after = F.lit(floor)
    else:
        progress = F.least(F.lit(1.0), (step - warmup).cast("double") / (config.max_steps - warmup))
        after = F.lit(floor) + (1.0 - floor) * 0.5 * (1.0 + F.cos(F.pi() * progress))
    if warmup == 0:
        return top * after
    return top * F.when(step < warmup, step.cast("double") / warmup).otherwise(after)


def step_plan(
    spark: SparkSession, windows: int, block_size: int, batch_size: int, config: StepConfig, drop_last: bool = True
) -> DataFrame:
    """One row per optimizer step: the batches it reads, their size, and its learning rate.

    Passes repeat until ``max_steps``.  The last step of a pass may accumulate fewer batches.
    """
    batches = batch_count(windows, batch_size, drop_last)
    if batches == 0:
        raise ValueError(f"{windows} windows make no batch of {batch_size}")
    usable = batches * batch_size if drop_last else windows
    accumulate = config.accumulate_grad_batches
    per_pass = -(-batches // accumulate)
    n_windows = F.least(F.lit(usable), (F.col("last_batch") + 1) * batch_size) - F.col("first_batch") * batch_size
    return (
        spark.range(config.max_steps)
        .select(F.col("id").cast("int").alias("step"))
        .withColumn("epoch", F.expr(f"cast(step div {per_pass} as int)"))
        .withColumn("first_batch", (F.col("step") % per_pass).cast("bigint") * accumulate)
        .withColumn("last_batch", F.least(F.col("first_batch") + accumulate, F.lit(batches)) - 1)
        .withColumn("n_windows", n_windows)
        .withColumn("n_tokens", F.col("n_windows") * block_size)
        .withColumn("lr", learning_rate(F.col("step"), config))
    )


def step_documents(
    stream: TokenStream, split: str, block_size: int, stride: int, batch_size: int, accumulate: int, drop_last: bool = True
) -> DataFrame:
    """``(step_in_pass, doc_id, n_tokens)``: how much of a document each step of a pass reads.

    Works on offsets and lengths alone; a token read by two windows counts twice.  A row of the work is a document and a
    step, not a window: how many tokens before a place the windows of a step hold is an arithmetic series, and what lies in
    a document is the difference of two of them.
    """
    windows = window_count(stream.totals[split], block_size, stride)
    usable = batch_count(windows, batch_size, drop_last) * batch_size
    per_step, span = batch_size * accumulate, block_size + 1
    segments = stream.segments.where((F.col("split") == split) & (F.col("token_len") > 0))
    first = F.greatest(F.lit(0), F.expr(f"(offset - {block_size} + {stride - 1}) div {stride}"))
    last = F.least(F.lit(min(usable, windows) - 1), F.expr(f"(offset + token_len - 1) div {stride}"))
    meeting = segments.select("doc_id", "offset", (F.col("offset") + F.col("token_len")).alias("end"), first.alias("first"), last.alias("last"))
    steps = F.sequence(F.expr(f"first div {per_step}"), F.expr(f"last div {per_step}"))
    pairs = meeting.where("first <= last").select("*", F.explode(steps).alias("step_in_pass"))
    a = F.col("step_in_pass") * per_step
    b = F.least(a + (per_step - 1), F.lit(min(usable, windows) - 1))

    def held_before(place: Column) -> Column:
        """Tokens before ``place`` in the windows ``a .. b``: of some windows all, of the next ones a falling part."""
        whole = F.least(F.greatest(F.floor((place - span) / stride) + 1 - a, F.lit(0)), b - a + 1)
        begun = F.least(F.greatest(F.floor((place - 1) / stride) + 1 - a, F.lit(0)), b - a + 1)
        part = begun - whole
        # windows a + whole .. a + begun - 1 give place - window * stride each
        return whole * span + part * place - stride * (part * (a + whole) + F.floor(part * (part - 1) / 2))

    counted = pairs.select("step_in_pass", "doc_id", (held_before(F.col("end")) - held_before(F.col("offset"))).alias("n_tokens"))
    return counted.groupBy("step_in_pass", "doc_id").agg(F.sum("n_tokens").alias("n_tokens"))


def order_manifest(documents: DataFrame, plan: DataFrame, accumulate: int) -> DataFrame:
    """Documents and tokens per step of a plan.  Each pass reads the same documents in the same order."""
    per_step = documents.groupBy("step_in_pass").agg(
        F.count("*").alias("n_documents"),
        F.min("doc_id").alias("min_doc_id"),
        F.max("doc_id").alias("max_doc_id"),
        F.sum("n_tokens").alias("tokens_read"),
    )
    steps = plan.select("step", "epoch", F.expr(f"first_batch div {accumulate}").alias("step_in_pass"))
    return steps.join(per_step, "step_in_pass").drop("step_in_pass")
