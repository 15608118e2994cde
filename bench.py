"""Time the headline stages on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and print one JSON line.

Each stage is run ``REPEATS`` times after a warm-up run on the smallest tables; the best run counts and
the slowest is reported as spread.  Inputs of a stage are written tables, so stages do not time each other.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators import scores
from corpusflow.operators.bpe import chunk_freq, learn_merges
from corpusflow.operators.codec import decode, encode, strip_special
from corpusflow.operators.filters import filter_report
from corpusflow.operators.split import holdout_split
from corpusflow.operators.stats import corpus_stats
from corpusflow.operators.stream import token_offsets
from corpusflow.operators.windows import batch, pack_windows, window_counts
from corpusflow.plans.steps import step_documents
from corpusflow.sources.token_bin import read_tokens, read_windows, write_stream
from corpusflow.storage import materialize, scratch_path, spread_small

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
VOCAB_SIZE = int(os.environ.get("BENCH_VOCAB_SIZE", "300"))
WARM_UP_DIR = "/root/testdata/sf0.001"
BLOCK = 256


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def run(spark: SparkSession, sf_dir: str, repeats: int) -> tuple[dict[str, list[float]], dict[str, float]]:
    times: dict[str, list[float]] = {}

    def timed(name, action, times_to_run=repeats):
        result = None
        for _ in range(times_to_run):
            began = time.perf_counter()
            result = action()
            times.setdefault(name, []).append(time.perf_counter() - began)
        return result

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents = spread_small(table.select("doc_id", "text"))
    timed("filter_report", lambda: consume(filter_report(table, 10, None, "source")))
    timed("pretokenize_counts", lambda: consume(chunk_freq(documents)))
    freq = materialize(chunk_freq(documents), "bench-freq")
    training = timed("learn_merges", lambda: learn_merges(freq, VOCAB_SIZE), 1)
    vocab = training.vocab
    split = spread_small(timed("holdout_split", lambda: holdout_split(table.select("doc_id", "text"), 0.05)))
    timed("encode", lambda: consume(encode(split, vocab)))
    encoded = timed("encode_and_store", lambda: materialize(encode(split, vocab), "bench-encoded"), 1)
    timed("corpus_stats", lambda: consume(corpus_stats(encoded)))
    timed("decode", lambda: consume(decode(encoded.withColumn("ids", strip_special("ids")), vocab)))
    stream = timed("token_offsets", lambda: token_offsets(encoded))
    counts = window_counts(stream.totals, BLOCK, BLOCK)
    windows = pack_windows(stream, BLOCK, BLOCK, vocab.eos_id, ["validation"])
    timed("windows", lambda: consume(windows))
    timed("batches", lambda: consume(batch(windows, 56, counts, ["train"])))
    timed("order_manifest", lambda: consume(step_documents(stream, "train", BLOCK, BLOCK, 8, 4)))
    path = scratch_path(spark, "bench-tokens")
    timed("token_bin_write", lambda: write_stream(stream, path, vocab.dtype))
    timed("token_bin_read", lambda: consume(read_tokens(spark, f"{path}/train", vocab.dtype)))
    timed("windows_from_files", lambda: consume(read_windows(spark, f"{path}/train", BLOCK, BLOCK, vocab.dtype)))

    def loss() -> None:
        held_out = batch(windows.where("split = 'validation'"), 56, counts)
        pairs = scores.bigram_counts(encoded.where("split = 'train'"))
        consume(scores.masked_loss(scores.score_tokens(held_out, pairs, vocab.n_vocab)))

    timed("masked_loss", loss)

    best = {name: min(values) for name, values in times.items()}
    n_docs, n_tokens = documents.count(), sum(stream.totals.values())
    n_chunks = freq.agg(F.sum("freq")).first()[0]
    rates = {
        "documents": n_docs,
        "tokens": n_tokens,
        "pretokenize_docs_per_sec": n_docs / best["pretokenize_counts"],
        "pretokenize_chunks_per_sec": n_chunks / best["pretokenize_counts"],
        "merge_rounds": training.rounds,
        "sec_per_round": best["learn_merges"] / max(1, training.rounds),
        "merges_per_round": len(vocab.merges) / max(1, training.rounds),
        "encode_docs_per_sec": n_docs / best["encode"],
        "encode_tokens_per_sec": n_tokens / best["encode"],
        "windows_per_sec": sum(counts.values()) / best["windows"],
        "windows_tokens_per_sec": n_tokens / best["windows"],
        "token_bin_write_tokens_per_sec": n_tokens / best["token_bin_write"],
        "token_bin_read_tokens_per_sec": stream.totals["train"] / best["token_bin_read"],
        "windows_from_files_tokens_per_sec": stream.totals["train"] / best["windows_from_files"],
    }
    return times, rates


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("corpusflow-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, WARM_UP_DIR, 1)
    times, rates = run(spark, SF_DIR, REPEATS)
    queries = {name: round(min(values), 3) for name, values in times.items()}
    print(
        json.dumps(
            {
                "metric": "total_best_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "slowest": {name: round(max(values), 3) for name, values in times.items()},
                "rates": {name: round(value, 3) for name, value in rates.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
