"""Losses over scored tokens, and choosing among scored items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.operators.windows import IGNORE_INDEX


def bigram_counts(encoded: DataFrame) -> DataFrame:
    """``(left_id, right_id, n)``: how often a token follows another within a document."""
    pairs = F.arrays_zip(
        F.slice("ids", F.lit(1), F.size("ids") - 1).alias("left_id"), F.slice("ids", F.lit(2), F.size("ids") - 1).alias("right_id")
    )
    return (
        encoded.select(F.inline(pairs).alias("left_id", "right_id"))
        .groupBy("left_id", "right_id")
        .agg(F.count("*").alias("n"))
    )


def score_tokens(windows: DataFrame, counts: DataFrame, vocab_size: int, k: float = 1.0, by: str = "batch_id") -> DataFrame:
    """Score targets by smoothed bigram counts, in place of a network's forward pass.

    ``(by, target, logp, weight)`` with one row per distinct (input, target) pair of a batch, so a pair
    that makes up much of the corpus is joined once per batch and not once per token.
    """
    seen = windows.select(by, F.inline(F.arrays_zip(F.col("x").alias("left_id"), F.col("y").alias("target"))))
    seen = seen.withColumn("left_id", F.when(F.col("target") != IGNORE_INDEX, F.col("left_id")))
    seen = seen.groupBy(by, "left_id", "target").agg(F.count("*").alias("weight"))
    totals = counts.groupBy("left_id").agg(F.sum("n").alias("n_left"))
    # ignored targets are one row of a batch, without a left id: they meet nothing in the joins
    scored = (
        seen.join(counts.withColumnRenamed("right_id", "target"), ["left_id", "target"], "left")
        .join(F.broadcast(totals), "left_id", "left")  # one short row per id of the vocabulary at most
    )
    smoothed = (F.coalesce("n", F.lit(0)) + k) / (F.coalesce("n_left", F.lit(0)) + k * vocab_size)
    logp = F.when(F.col("target") != IGNORE_INDEX, F.log(smoothed))
    return scored.select(by, "target", logp.alias("logp"), "weight")


def masked_loss(scored: DataFrame, by: str = "batch_id") -> DataFrame:
    """Per batch: mean ``-logp`` over targets that are not ignored, and its exponential.

    A batch in which every target is ignored has NULL loss.  ``weight`` (rows a row stands for) is
    taken as 1 when the column is missing.
    """
    weight = F.col("weight") if "weight" in scored.columns else F.lit(1)
    counted = F.when(F.col("target") != IGNORE_INDEX, weight)
    return (
        scored.groupBy(by)
        .agg(F.sum(-F.col("logp") * counted).alias("total"), F.coalesce(F.sum(counted), F.lit(0)).alias("n_targets"))
        .select(by, "n_targets", F.try_divide("total", "n_targets").alias("loss"))
        .withColumn("perplexity", F.exp("loss"))
    )


def validation_summary(losses: DataFrame, n_rows: Column | None = None) -> DataFrame:
    """Mean loss and mean perplexity over batches, weighted by batch size (``n_rows``) when given."""
    weight = F.lit(1) if n_rows is None else n_rows
    return losses.where(F.col("loss").isNotNull()).agg(
        F.count("*").alias("batches"),
        (F.sum(F.col("loss") * weight) / F.sum(weight)).alias("val_loss"),
        (F.sum(F.col("perplexity") * weight) / F.sum(weight)).alias("val_ppl"),
    )


def softmax(scores: DataFrame, temperature: float = 1.0, group: str = "group_id") -> DataFrame:
    """Add ``p``: the softmax of ``score`` within each group; a temperature of 0 or less does not scale.

    A group is one score vector over a vocabulary, so its size is bounded by the vocabulary.
    """
    whole = Window.partitionBy(group)
    shifted = F.col("score") - F.max("score").over(whole)
    if temperature > 0:
        shifted = shifted / temperature
    return (
        scores.withColumn("share", F.exp(shifted))
        .withColumn("p", F.col("share") / F.sum("share").over(whole))
        .drop("share")
    )


def _ranked(group: str, item: str):
    return Window.partitionBy(group).orderBy(F.desc("p"), item)


def top_p(probs: DataFrame, threshold: float, group: str = "group_id", item: str = "item_id") -> DataFrame:
    """Keep the most probable items until their sum passes ``threshold``; the item that crosses it stays.

    Kept probabilities are scaled to sum to 1.  Equal probabilities are ranked by item.
    """
    if threshold >= 1:
        return probs
    before = _ranked(group, item).rowsBetween(Window.unboundedPreceding, -1)
    kept = probs.withColumn("before", F.sum("p").over(before)).where(
        F.col("before").isNull() | (F.col("before") <= threshold)  # nothing comes before the first item
    )
    return kept.withColumn("p", F.col("p") / F.sum("p").over(Window.partitionBy(group))).drop("before")


def argmax(scores: DataFrame, group: str = "group_id", item: str = "item_id") -> DataFrame:
    """The item with the highest score of each group; the smallest item among equals."""
    return scores.groupBy(group).agg(F.max_by(item, F.struct("score", (-F.col(item)).alias("tie"))).alias(item))


def uniform(seed: int, group: Column | str) -> Column:
    """A repeatable number in [0, 1) per group: 52 bits of a seeded hash."""
    group = F.col(group) if isinstance(group, str) else group
    digest = F.md5(F.concat(F.lit(f"{seed}:"), group.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / float(1 << 52)


def draw(probs: DataFrame, seed: int, group: str = "group_id", item: str = "item_id") -> DataFrame:
    """One item per group, with its probability; the same seed draws the same items."""
    before = _ranked(group, item).rowsBetween(Window.unboundedPreceding, -1)
    cumulative = probs.withColumn("before", F.coalesce(F.sum("p").over(before), F.lit(0.0)))
    return (
        cumulative.where(F.col("before") <= uniform(seed, group))
        .groupBy(group)
        .agg(F.max_by(item, F.struct("before", F.col(item).alias("tie"))).alias(item))
    )
