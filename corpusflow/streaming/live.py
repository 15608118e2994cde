"""Documents that keep arriving: the batch operators on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.codec import encode
from corpusflow.operators.filters import length_filter
from corpusflow.operators.stats import corpus_stats
from corpusflow.operators.vocabulary import Vocabulary


def read_documents(spark: SparkSession, folder: str, schema: str, **options: object) -> DataFrame:
    """Parquet files as they appear in a folder."""
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def encode_stream(
    documents: DataFrame, vocab: Vocabulary, min_length: int | None = None, max_length: int | None = None
) -> DataFrame:
    """Filter and encode arriving documents; stateless, so it scales like the batch form."""
    return encode(length_filter(documents, min_length, max_length), vocab)


def append_encoded(encoded: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet folder, each document exactly once across restarts."""
    return (
        encoded.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def running_stats(encoded: DataFrame, by: str = "split") -> DataFrame:
    """Length statistics so far, per split; the state is one row per split."""
    return corpus_stats(encoded, by)


def throughput_by_window(log: DataFrame, window: str = "1 minute", delay: str = "1 hour") -> DataFrame:
    """Steps, tokens and tokens per second of each run in tumbling windows, once a window is closed.

    ``log`` has ``run_id, ts, n_tokens``.  ``ts`` is cast because a watermark needs a zoned timestamp.
    """
    return (
        log.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", window).alias("span"), "run_id")
        .agg(F.count("*").alias("steps"), F.sum("n_tokens").alias("n_tokens"))
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "run_id",
            "steps",
            "n_tokens",
            (F.col("n_tokens") / (F.unix_seconds("span.end") - F.unix_seconds("span.start"))).alias("tokens_per_sec"),
        )
    )
