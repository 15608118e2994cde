"""Counts and length statistics of encoded documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.vocabulary import Vocabulary


def corpus_stats(encoded: DataFrame, by: str = "split") -> DataFrame:
    """Per split: documents, tokens, and min/max/mean length in characters and in tokens."""
    aggregates = [F.count("*").alias("examples"), F.sum("token_len").cast("bigint").alias("tokens")]
    for unit in ("char", "token"):
        length = F.col(f"{unit}_len")
        aggregates += [
            F.min(length).cast("double").alias(f"{unit}_min"),
            F.max(length).cast("double").alias(f"{unit}_max"),
            (F.sum(length).cast("double") / F.count("*")).alias(f"{unit}_mean"),
        ]
    return encoded.groupBy(by).agg(*aggregates)


def corpus_metadata(
    encoded: DataFrame,
    vocab: Vocabulary,
    used_existing_split: bool,
    val_split: float | None = None,
    seed: int | None = None,
) -> DataFrame:
    """One row that describes a tokenized corpus.  An empty split has counts 0 and NULL statistics."""
    stats = corpus_stats(encoded, "split").select(
        "split",
        "examples",
        "tokens",
        F.struct(
            *(
                F.struct(*(F.col(f"{unit}_{what}").alias(what) for what in ("min", "max", "mean"))).alias(unit)
                for unit in ("char", "token")
            )
        ).alias("length_stats"),
    )

    def of(split: str, column: str):
        return F.max(F.when(F.col("split") == split, F.col(column)))

    names = {"train": "train", "val": "validation"}
    columns = [
        F.lit(vocab.n_vocab).alias("vocab_size"),
        *(F.lit(getattr(vocab, f"{role}_id")).alias(f"{role}_token_id") for role in ("bos", "eos", "pad", "unk")),
        F.lit(vocab.dtype).alias("dtype"),
        *(F.coalesce(of(split, "tokens"), F.lit(0)).cast("bigint").alias(f"{name}_tokens") for name, split in names.items()),
        *(F.coalesce(of(split, "examples"), F.lit(0)).cast("bigint").alias(f"{name}_examples") for name, split in names.items()),
        *(of(split, "length_stats").alias(f"{name}_length_stats") for name, split in names.items()),
        F.lit(used_existing_split).alias("used_existing_split"),
    ]
    if not used_existing_split:
        columns += [F.lit(val_split).cast("double").alias("val_split"), F.lit(seed).cast("bigint").alias("seed")]
    return stats.agg(*columns)
