"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import held_out, pick, staged


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, per_class: int, unlabelled: int = 0
) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, label, text)`` of at most ``per_class`` ids with label 0, as many with label 1, and ``unlabelled`` others.

    Also returns how many ids have each label.  Ids that are held out, or null, or have both labels are not
    learned from; an id with several texts gives one of them.  Which ids are taken depends on a hash
    of the id alone.  Rows of the sample without a known label have a null one.
    """
    known = (
        pick(labels, "doc_id", label)
        .toDF("doc_id", "label")
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("doc_id", "label")
    )
    counts = {0: 0, 1: 0} | {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("label = 0").orderBy(*order).limit(per_class)
    chosen = chosen.unionByName(known.where("label = 1").orderBy(*order).limit(per_class))
    texts = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if unlabelled:
        others = texts.select("doc_id", F.lit(None).cast("int").alias("label")).where(~held_out(F.col("doc_id")))
        chosen = chosen.unionByName(others.orderBy(*order).limit(unlabelled))
    chosen = staged(chosen.groupBy("doc_id").agg(F.max("label").alias("label")), "sample-ids")
    # at most 2 * per_class + unlabelled short rows
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return staged(rows.withColumn("text", F.coalesce("text", F.lit(""))), "sample"), counts


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 60) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps, damped where a step does not help; ``y`` may be soft."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(weight * (np.logaddexp(0, z) - y * z)) + ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    at = loss(w)
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        scale = 1.0
        while scale > 1e-6 and loss(w - scale * step) > at:
            scale /= 2
        w = w - scale * step
        before, at = at, loss(w)
        if before - at < 1e-9 * max(1.0, before):
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
