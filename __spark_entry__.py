"""Registered queries and the SQL that gives the same rows.

``queries()`` only wires operators of the package to the given tables.  Id arrays leave as digests, so
results are plain columns.  Most queries use the byte vocabulary (no merges): it goes through the same
code as a learned one, and its ids are the UTF-8 bytes, which SQL can compute as well.
"""

from __future__ import annotations

import logging
import os
import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.ordering import with_hash_order, with_id_order
from corpusflow.operators import scores
from corpusflow.operators.bpe import chunk_freq, learn_merges, pair_table
from corpusflow.operators.codec import (
    cut_at_eos,
    decode,
    drop_empty,
    encode,
    encode_ids,
    prepare_prompts,
    roundtrip_report,
    strip_special,
)
from corpusflow.operators.filters import filter_report, length_filter
from corpusflow.operators.runlog import throughput
from corpusflow.operators.split import holdout_split
from corpusflow.operators.stats import corpus_metadata, corpus_stats
from corpusflow.operators.stream import TokenStream, token_offsets, token_prefix
from corpusflow.operators.vocabulary import Vocabulary
from corpusflow.operators.windows import batch, pack_windows, window_counts
from corpusflow.plans.build import training_batches
from corpusflow.plans.steps import order_manifest, step_documents, step_plan, token_budget
from corpusflow.sources.config import CorpusConfig, StepConfig, WindowConfig
from corpusflow.sources.corpus import read_corpus, resolve_splits, write_tokenized
from corpusflow.sources.token_bin import append_tokens, arriving_windows, copy_prefix, read_manifest, read_tokens, read_windows, write_stream
from corpusflow.storage import materialize, scratch_path, small_shuffles, spread_small
from corpusflow.streaming.append_pack import AppendPacker
from corpusflow.streaming.append_state import append_windows, continued_windows
from corpusflow.streaming.live import append_encoded, encode_stream, read_documents, running_stats, throughput_by_window

BYTES = Vocabulary()
FRACTION, SEED = 0.05, 42
BLOCK, STRIDE, BATCH = 256, 192, 8
STEPS = StepConfig(
    learning_rate=3.0e-4, min_lr=6.0e-5, warmup_ratio=0.01, max_steps=1962, accumulate_grad_batches=4, scheduler="cosine"
)
#: Arriving documents come in so many parts, in more where a part would be larger.
PARTS, PART_BYTES = 3, 256 << 20
DOCUMENT_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


# --- inputs -------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _corpus_config(sf_dir: str) -> CorpusConfig:
    return CorpusConfig(
        name="documents",
        source="local",
        text_field="text",
        splits={"train": "train", "validation": "validation"},
        path=f"{sf_dir}/documents.parquet",
        id_field="doc_id",
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents about to be tokenized."""
    return spread_small(_documents(spark, sf_dir))


def _held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(holdout_split(_documents(spark, sf_dir), FRACTION, SEED))


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents held out, ordered by seed and encoded, as a written table."""
    return materialize(encode(_held_out(spark, sf_dir), BYTES), "encoded")


def _by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source as split, in id order, encoded."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("split"))
    return materialize(encode(with_id_order(spread_small(rows)), BYTES), "encoded")


def _stream(spark: SparkSession, sf_dir: str) -> TokenStream:
    return token_offsets(_encoded(spark, sf_dir))


def _digest(ids: str):
    return F.md5(F.array_join(ids, ",").cast("binary"))


def _window_rows(windows: DataFrame) -> DataFrame:
    return windows.withColumn("x", _digest("x")).withColumn("y", _digest("y"))


# --- queries ------------------------------------------------------------------------------------


def corpus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _corpus_config(sf_dir)
    corpus, existing = resolve_splits(read_corpus(spark, config), config)
    return corpus.select(
        "split", "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.lit(existing).alias("existing_validation")
    )


def q_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = length_filter(_documents(spark, sf_dir), 10, 20000)
    return kept.select("doc_id", F.char_length("text").alias("char_len"))


def q_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = _documents(spark, sf_dir).withColumn("text", F.regexp_replace("text", "[^0-9]", ""))
    return drop_empty(digits).select("doc_id", F.char_length("text").alias("char_len"))


def q_filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_report(_table(spark, sf_dir, "documents"), 10, None, "source")


def q_holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holdout_split(_documents(spark, sf_dir), FRACTION, SEED).select("doc_id", "split", "order_key")


def pretokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_freq(_texts(spark, sf_dir))


def byte_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_table(chunk_freq(_texts(spark, sf_dir)))


def bpe_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = learn_merges(chunk_freq(_texts(spark, sf_dir)), 300)
    path = scratch_path(spark, "vocabulary")
    run.vocab.save(spark, path)
    return Vocabulary.load(spark, path).to_df(spark).withColumn("bytes", F.hex("bytes"))


def bpe_merges_512(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = learn_merges(chunk_freq(_texts(spark, sf_dir)), 512).vocab
    return vocab.to_df(spark).where("left_id IS NOT NULL").select("token_id", "left_id", "right_id", "pair_freq")


def bpe_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = learn_merges(chunk_freq(_texts(spark, sf_dir)), 264)
    return run.report(spark).select("vocab_size", "merges", F.array_join("special_tokens", " ").alias("special_tokens"))


def encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(_texts(spark, sf_dir), BYTES)
    return encoded.select("doc_id", "char_len", "token_len", _digest("ids").alias("ids"))


def encode_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _texts(spark, sf_dir)
    encoded = encode(documents, learn_merges(chunk_freq(documents), 280).vocab)
    return encoded.select("doc_id", "char_len", "token_len", _digest("ids").alias("ids"))


def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(_texts(spark, sf_dir), BYTES).withColumn("ids", strip_special("ids"))
    return decode(encoded, BYTES).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def q_roundtrip_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _documents(spark, sf_dir).select("text").unionByName(_table(spark, sf_dir, "benchmark").select("text"))
    return roundtrip_report(spread_small(texts), BYTES)


def q_corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_stats(encode(_held_out(spark, sf_dir), BYTES)).withColumns(
        {f"{unit}_mean": F.round(f"{unit}_mean", 6) for unit in ("char", "token")}
    )


def q_corpus_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = corpus_metadata(_encoded(spark, sf_dir), BYTES, False, FRACTION, SEED)
    flat = [name for name in row.columns if not name.endswith("length_stats")]
    stats = [
        F.round(F.col(f"{split}_length_stats.{unit}.{what}"), 6).alias(f"{split}_{unit}_{what}")
        for split in ("train", "val")
        for unit in ("char", "token")
        for what in ("min", "max", "mean")
    ]
    return row.select(*flat, *stats)


def q_token_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_offsets(_encoded(spark, sf_dir).drop("ids")).segments.select("split", "doc_id", "offset", "token_len")


def token_offsets_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _by_source(spark, sf_dir).drop("ids")
    return token_offsets(encoded).segments.select("split", "doc_id", "offset", "token_len")


def q_token_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = token_prefix(_stream(spark, sf_dir), {"train": 100_000, "validation": 10_000})
    return prefix.select("split", "doc_id", "offset", "token_len", _digest("ids").alias("ids"))


def train_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _stream(spark, sf_dir)
    train = TokenStream(stream.segments.where("split = 'train'"), {"train": stream.totals["train"]})
    return _window_rows(pack_windows(train, BLOCK, STRIDE))


def windows_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = pack_windows(_stream(spark, sf_dir), BLOCK, BLOCK, BYTES.eos_id, ["validation"])
    return _window_rows(windows)


def q_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = token_offsets(_by_source(spark, sf_dir).drop("ids"))
    counts = window_counts(stream.totals, BLOCK, STRIDE)
    rows = [(split, stream.totals[split], count) for split, count in counts.items()]
    return spark.createDataFrame(rows, "split STRING, n_tokens BIGINT, windows BIGINT")


def window_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = pack_windows(_stream(spark, sf_dir), BLOCK, STRIDE, BYTES.eos_id, ["validation"], (3, 40))
    return _window_rows(windows)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _stream(spark, sf_dir)
    windows = pack_windows(stream, BLOCK, BLOCK, BYTES.eos_id, ["validation"])
    counts = window_counts(stream.totals, BLOCK, BLOCK)
    return _window_rows(batch(windows, BATCH, counts, ["train"])).select(
        "split", "batch_id", "row_in_batch", "window_id", "x", "y"
    )


def q_training_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of a configured run, read from token files."""
    path = _token_files(spark, sf_dir)
    config = WindowConfig(f"{path}/train", f"{path}/validation", BLOCK, BLOCK, BYTES.dtype, BYTES.eos_id, BATCH, drop_last=True)
    train, held_out = training_batches(spark, config, context_length=BLOCK)
    return _window_rows(train.unionByName(held_out)).select("split", "batch_id", "row_in_batch", "window_id", "x", "y")


def learned_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way with a learned vocabulary: merges, ids, one stream, token files, windows."""
    documents = _texts(spark, sf_dir)
    vocab = learn_merges(chunk_freq(documents), 280).vocab
    encoded = encode(with_id_order(documents.withColumn("split", F.lit("train"))), vocab)
    path = scratch_path(spark, "learned-tokens")
    write_stream(token_offsets(materialize(encoded, "learned")), path, vocab.dtype)
    return _window_rows(read_windows(spark, f"{path}/train", BLOCK, STRIDE, vocab.dtype, "train"))


def q_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = token_offsets(_encoded(spark, sf_dir).drop("ids"))
    return token_budget(spark, stream.totals, BLOCK, STRIDE, BATCH, STEPS.accumulate_grad_batches, ["train"])


def _plan(spark: SparkSession, stream: TokenStream) -> DataFrame:
    windows = window_counts(stream.totals, BLOCK, STRIDE)["train"]
    return step_plan(spark, windows, BLOCK, BATCH, STEPS)


def q_step_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = token_offsets(_encoded(spark, sf_dir).drop("ids"))
    return _plan(spark, stream).withColumn("lr", F.round("lr", 12))


def q_order_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = token_offsets(_encoded(spark, sf_dir).drop("ids"))
    accumulate = STEPS.accumulate_grad_batches
    documents = step_documents(stream, "train", BLOCK, STRIDE, BATCH, accumulate)
    return order_manifest(documents, _plan(spark, stream), accumulate)


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare_prompts(_table(spark, sf_dir, "conversations"), BYTES, 128)
    return rows.select("conv_id", "turn", F.size("ids").alias("n_ids"), _digest("ids").alias("ids"))


def q_cut_at_eos(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = encode(_table(spark, sf_dir, "conversations"), BYTES)
    twice = turns.withColumn("ids", F.concat("ids", "ids"))
    cut = twice.withColumn("ids", cut_at_eos("ids", BYTES.eos_id, 400))
    return cut.select("conv_id", "turn", F.size("ids").alias("n_ids"), _digest("ids").alias("ids"))


def _step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.char_length("props").cast("bigint").alias("n_tokens"),
    )


def _rates(rows: DataFrame) -> DataFrame:
    return rows.select("run_id", "step", F.round("tokens_per_sec", 9).alias("tokens_per_sec"), "tokens_processed")


def q_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(throughput(_step_log(spark, sf_dir), every_n=3, steps_per_slice=1000))


def throughput_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(throughput(_step_log(spark, sf_dir), every_n=3, count="sampled", steps_per_slice=1000))


def _losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _encoded(spark, sf_dir)
    stream = token_offsets(encoded)
    held_out = TokenStream(stream.segments.where("split = 'validation'"), {"validation": stream.totals["validation"]})
    windows = pack_windows(held_out, BLOCK, BLOCK, BYTES.eos_id, ["validation"])
    rows = batch(windows, BATCH, window_counts(held_out.totals, BLOCK, BLOCK))
    counts = scores.bigram_counts(encoded.where("split = 'train'"))
    losses = scores.masked_loss(scores.score_tokens(rows, counts, BYTES.n_vocab))
    # the last batch may be incomplete
    windows_left = F.lit(window_counts(held_out.totals, BLOCK, BLOCK)["validation"]) - F.col("batch_id") * BATCH
    return losses.withColumn("n_rows", F.least(F.lit(BATCH), windows_left))


def q_masked_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _losses(spark, sf_dir).select(
        "batch_id", "n_targets", F.round("loss", 6).alias("loss"), F.round("perplexity", 5).alias("perplexity")
    )


def validation_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = scores.validation_summary(_losses(spark, sf_dir), F.col("n_rows"))
    return summary.select("batches", F.round("val_loss", 6).alias("val_loss"), F.round("val_ppl", 5).alias("val_ppl"))


def _bigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score vector per token: the log count of each token that follows it."""
    counts = scores.bigram_counts(encode(_texts(spark, sf_dir), BYTES))
    return counts.select(
        F.col("left_id").alias("group_id"), F.col("right_id").alias("item_id"), F.log("n").alias("score")
    )


def q_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.softmax(_bigram_scores(spark, sf_dir), 0.5).select("group_id", "item_id", F.round("p", 9).alias("p"))


def q_top_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = scores.top_p(scores.softmax(_bigram_scores(spark, sf_dir)), 0.91373)
    return kept.select("group_id", "item_id", F.round("p", 9).alias("p"))


def q_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.argmax(_bigram_scores(spark, sf_dir))


def weighted_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = scores.top_p(scores.softmax(_bigram_scores(spark, sf_dir)), 0.91373)
    return scores.draw(kept, SEED)


def _token_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "tokens")
    write_stream(_stream(spark, sf_dir), path, BYTES.dtype)
    return path


def token_bin_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _token_files(spark, sf_dir)
    tokens = _both_splits(lambda split: read_tokens(spark, f"{path}/{split}", BYTES.dtype).select(
        F.lit(split).alias("split"), F.posexplode("tokens").alias("i", "token"), "pos"
    ))
    return _as_long(materialize(_token_sums(tokens), "token-sums"), "weighted_sum")


def _token_sums(tokens: DataFrame) -> DataFrame:
    """Sums of ``split, pos, i, token`` per split; those by position outgrow 64 bits within some hundred million tokens."""
    # what a stored row adds fits; only rows are summed as decimals
    rows = tokens.groupBy("split", "pos").agg(
        F.count("*").alias("n"), F.sum("token").alias("total"), F.sum(F.expr("(i + 1L) * token")).alias("inside")
    )
    weighted = F.col("pos").cast("decimal(19,0)") * F.col("total").cast("decimal(18,0)") + F.col("inside")
    return rows.groupBy("split").agg(
        F.sum("n").alias("n_tokens"), F.sum("total").alias("token_sum"), F.sum(weighted.cast("decimal(38,0)")).alias("weighted_sum")
    )


def _as_long(sums: DataFrame, name: str) -> DataFrame:
    """A decimal column of a few rows as BIGINT, where all its numbers are in range; else it stays."""
    low, high = sums.agg(F.min(name), F.max(name)).first()
    fits = low is None or -(2**63) <= low and high < 2**63
    return sums.withColumn(name, F.col(name).cast("bigint")) if fits else sums


def token_bin_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _token_files(spark, sf_dir)
    return _both_splits(lambda split: read_manifest(spark, f"{path}/{split}").select(F.lit(split).alias("split"), "n_tokens")).groupBy(
        "split"
    ).agg(F.sum("n_tokens").alias("n_tokens"))


def token_bin_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _token_files(spark, sf_dir)
    return _window_rows(
        _both_splits(
            lambda split: read_windows(
                spark, f"{path}/{split}", BLOCK, BLOCK, BYTES.dtype, split, BYTES.eos_id, split == "validation"
            )
        )
    )


def token_bin_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = f"{_token_files(spark, sf_dir)}/train", scratch_path(spark, "prefix")
    copy_prefix(spark, source, target, 100_000, BYTES.dtype)
    tokens = read_tokens(spark, target, BYTES.dtype).select("pos", F.posexplode("tokens").alias("i", "token"))
    return tokens.agg(
        F.count("*").alias("n_tokens"),
        F.sum("token").alias("token_sum"),
        F.sum(F.expr("(pos + i + 1) * token")).cast("bigint").alias("weighted_sum"),
    )


def token_bin_window_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _token_files(spark, sf_dir)
    return _window_rows(read_windows(spark, f"{path}/train", BLOCK, STRIDE, BYTES.dtype, "train", window_range=(3, 40)))


def corpus_scan_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stored as named splits, the validation split among them, and read back."""
    path = scratch_path(spark, "named-splits")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    for split, mine in (("train", F.col("lang") != "en"), ("validation", F.col("lang") == "en")):
        documents.where(mine).write.parquet(f"{path}/{split}")
    config = replace(_corpus_config(sf_dir), path=path)
    corpus, existing = resolve_splits(read_corpus(spark, config), config)
    return corpus.select(
        "split", "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.lit(existing).alias("existing_validation")
    )


def _both_splits(read: Callable[[str], DataFrame]) -> DataFrame:
    return read("train").unionByName(read("validation"))


def tokenized_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = write_tokenized(encode(_held_out(spark, sf_dir), BYTES), scratch_path(spark, "tokenized"))
    return stored.select("split", "doc_id", "char_len", "token_len", _digest("ids").alias("ids"))


def _arrivals(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """Documents that arrive in id order in several parts, one micro-batch each, so that state carries over.

    The stream is handed out anew for each part that has come, for queries that go on from their checkpoint.  Every id of a part
    comes before those of the next one, however many files they are in; documents without an id come last.
    """
    documents, staged, path = _table(spark, sf_dir, "documents"), scratch_path(spark, "parts"), scratch_path(spark, "arriving")
    size = int(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(PARTS, -(-size // PART_BYTES))
    cuts = documents.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.03 / parts)
    part = sum(((F.col("doc_id") > cut).cast("int") for cut in cuts), F.lit(0))
    part = F.when(F.col("doc_id").isNull(), F.lit(parts)).otherwise(part)
    # neighbouring ids share files, so a part has few of them; equal ids may be in several
    near = documents.repartitionByRange(parts * spark.sparkContext.defaultParallelism, "doc_id", F.xxhash64("text"))
    near.withColumn("part", part).write.partitionBy("part").parquet(staged)
    stored = spark.read.schema(f"{DOCUMENT_SCHEMA}, part INT").parquet(staged)
    for number in sorted(row["part"] for row in stored.select("part").distinct().collect()) or [0]:
        stored.where(F.col("part") == number).drop("part").write.mode("append").parquet(path)
        yield read_documents(spark, path, DOCUMENT_SCHEMA)


def stream_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, checkpoint = scratch_path(spark, "stream-encoded"), scratch_path(spark, "stream-checkpoint")
    for live in _arrivals(spark, sf_dir):
        encoded = encode_stream(live.select("doc_id", "text"), BYTES, min_length=10)
        append_encoded(encoded, target, checkpoint).awaitTermination()
    stored = spark.read.parquet(target)
    return stored.select("doc_id", "char_len", "token_len", _digest("ids").alias("ids"))


def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = (part.select(F.col("source").alias("split"), "text") for part in _arrivals(spark, sf_dir))
    return _finished(spark, (running_stats(encode_stream(rows, BYTES)) for rows in live), "complete").withColumns(
        {f"{unit}_mean": F.round(f"{unit}_mean", 6) for unit in ("char", "token")}
    )


def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    live = read_documents(spark, sf_dir, schema, pathGlobFilter="events.parquet")
    log = live.select(F.col("user_id").alias("run_id"), "ts", F.char_length("props").cast("bigint").alias("n_tokens"))
    rows = _finished(spark, [throughput_by_window(log, "1 day", "1 hour")], "append")
    return rows.select(
        F.unix_seconds("window_start").alias("window_start"), "run_id", "steps", "n_tokens",
        F.round("tokens_per_sec", 9).alias("tokens_per_sec"),
    )


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    packer = AppendPacker(BYTES, scratch_path(spark, "append"), BLOCK, STRIDE, mask=True)
    checkpoint = scratch_path(spark, "append-checkpoint")
    for live in _arrivals(spark, sf_dir):
        packer.start(live.select("doc_id", "text"), checkpoint).awaitTermination()
    return _window_rows(packer.read(spark))


def stream_windows_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A token stream of each source, continued from micro-batch to micro-batch."""
    target, checkpoint = scratch_path(spark, "continued"), scratch_path(spark, "continued-checkpoint")
    for live in _arrivals(spark, sf_dir):
        rows = live.select(F.col("source").alias("split"), "doc_id", "text")
        windows = continued_windows(rows, BYTES, BLOCK, STRIDE, masked=True)
        with small_shuffles(spark):  # one row of state a source
            append_windows(windows, target, checkpoint).awaitTermination()
    return _window_rows(spark.read.parquet(target))


def _growing_files(spark: SparkSession, sf_dir: str) -> str:
    """Documents encoded as they arrive and appended to token files, one epoch a micro-batch."""
    path, checkpoint = scratch_path(spark, "growing"), scratch_path(spark, "growing-checkpoint")
    for live in _arrivals(spark, sf_dir):
        encoded = encode_stream(live.select("doc_id", "text"), BYTES)
        append_tokens(encoded, path, checkpoint, BYTES.dtype).awaitTermination()
    return path


def token_bin_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each token came through the files."""
    tokens = read_tokens(spark, _growing_files(spark, sf_dir), BYTES.dtype).select(F.explode("tokens").alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def token_bin_arriving_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of growing files, taken up by a streaming query as they become whole."""
    target = scratch_path(spark, "arriving-windows")
    windows = arriving_windows(spark, _growing_files(spark, sf_dir), BLOCK, STRIDE, BYTES.dtype)
    append_encoded(windows, target, scratch_path(spark, "arriving-checkpoint")).awaitTermination()
    return spark.read.parquet(target).select("window_id", F.size("x").alias("n_inputs"), F.size("y").alias("n_targets"))


def _finished(spark: SparkSession, streams: Iterable[DataFrame], mode: str) -> DataFrame:
    """Run a streaming aggregate over all there is, each time anew that more has come, and return what it emitted."""
    path, checkpoint = scratch_path(spark, "emitted"), scratch_path(spark, "checkpoint")

    def store(rows: DataFrame, batch_id: int) -> None:
        # in complete mode each batch replaces the result, in append mode it adds to it
        name = "all" if mode == "complete" else f"batch-{batch_id}"
        rows.write.mode("overwrite").parquet(f"{path}/{name}")

    for streaming in streams:
        with small_shuffles(spark):  # state is a few rows per split or run
            query = (
                streaming.writeStream.foreachBatch(store)
                .outputMode(mode)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the ``llm`` folder and of the pipeline, where these are installed."""
    found, sql = {}, {}
    try:
        from corpusflow.llm.queries import QUERIES
        from corpusflow.llm.sql import ORACLE_SQL

        found, sql = dict(QUERIES), dict(ORACLE_SQL)
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ImportError as error:  # the folders, or libraries they need, are not there; all other queries are
        logging.getLogger(__name__).warning("without training-data queries: %s", error)
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return own_sql() | _training_data()[1]


def entry(spark: SparkSession) -> DataFrame:
    """Documents cut into training windows, masked for validation."""
    return windows_masked(spark, "/root/testdata/sf0.001")


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "corpus_scan": corpus_scan,
        "length_filter": q_length_filter,
        "drop_empty": q_drop_empty,
        "filter_report": q_filter_report,
        "holdout_split": q_holdout_split,
        "pretokenize_counts": pretokenize_counts,
        "byte_pair_counts": byte_pair_counts,
        "bpe_vocab": bpe_vocab,
        "bpe_report": bpe_report,
        "encode_documents": encode_documents,
        "encode_learned": encode_learned,
        "encode_roundtrip": encode_roundtrip,
        "roundtrip_report": q_roundtrip_report,
        "corpus_stats": q_corpus_stats,
        "corpus_metadata": q_corpus_metadata,
        "token_offsets": q_token_offsets,
        "token_offsets_by_source": token_offsets_by_source,
        "token_prefix": q_token_prefix,
        "train_windows": train_windows,
        "windows_masked": windows_masked,
        "window_counts": q_window_counts,
        "window_lookup": window_lookup,
        "batches": batches,
        "token_budget": q_token_budget,
        "step_plan": q_step_plan,
        "order_manifest": q_order_manifest,
        "prompts": prompts,
        "cut_at_eos": q_cut_at_eos,
        "throughput": q_throughput,
        "throughput_sampled": throughput_sampled,
        "masked_loss": q_masked_loss,
        "validation_loss": validation_loss,
        "softmax": q_softmax,
        "top_p": q_top_p,
        "argmax": q_argmax,
        "weighted_draw": weighted_draw,
        "token_bin_roundtrip": token_bin_roundtrip,
        "token_bin_manifest": token_bin_manifest,
        "token_bin_windows": token_bin_windows,
        "token_bin_prefix": token_bin_prefix,
        "token_bin_window_lookup": token_bin_window_lookup,
        "corpus_scan_splits": corpus_scan_splits,
        "tokenized_table": tokenized_table,
        "stream_encode": stream_encode,
        "stream_stats": stream_stats,
        "stream_throughput": stream_throughput,
        "stream_windows": stream_windows,
        "stream_windows_by_source": stream_windows_by_source,
        "training_batches": q_training_batches,
        "learned_windows": learned_windows,
        "bpe_merges_512": bpe_merges_512,
        "token_bin_append": token_bin_append,
        "token_bin_arriving_windows": token_bin_arriving_windows,
    }


# --- SQL ----------------------------------------------------------------------------------------

_IDS = (
    "list_concat([258], list_transform(regexp_extract_all(hex(encode(text)), '..'), "
    "lambda h: ('0x' || h)::INT), [257])"
)
_HELD_OUT = f"""
ranked AS (SELECT doc_id, text, md5('{SEED}:' || doc_id) AS order_key,
                  row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) AS rn, count(*) OVER () AS n
           FROM documents),
held_out AS (SELECT CASE WHEN rn <= ceil({FRACTION} * n) THEN 'validation' ELSE 'train' END AS split,
                    doc_id, text, order_key FROM ranked)
"""
_ENCODED = f"""{_HELD_OUT},
encoded AS (SELECT split, doc_id, order_key, length(text) AS char_len,
                   octet_length(encode(text)) + 2 AS token_len, {_IDS} AS ids
            FROM held_out WHERE text <> '')
"""
_OFFSETS = """
placed AS (SELECT *, coalesce(sum(token_len) OVER (PARTITION BY split ORDER BY order_key, doc_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
                  sum(token_len) OVER (PARTITION BY split)::BIGINT AS total FROM encoded)
"""
_STREAM = f"WITH {_ENCODED}, {_OFFSETS}"
_ARRIVED = f"""WITH encoded AS (
  SELECT 'train' AS split, doc_id, '' AS order_key, octet_length(encode(text)) + 2 AS token_len, {_IDS} AS ids
  FROM documents WHERE text <> ''), {_OFFSETS}"""


def _windows_sql(block: int, stride: int, masked: str, source: str = _STREAM) -> str:
    """Windows by unnesting every token; ``masked`` is a condition on ``split``."""
    return f"""{source},
tokens AS (SELECT split, total, "offset" + i - 1 AS pos, id FROM (
             SELECT split, total, "offset", unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM placed)),
members AS (SELECT split, pos, id, unnest(range(greatest(0, (pos - {block} + {stride} - 1) // {stride}),
                   least((total - {block + 1}) // {stride}, pos // {stride}) + 1)) AS window_id FROM tokens),
cut AS (SELECT split, window_id, list(id ORDER BY pos) AS z FROM members GROUP BY ALL),
halves AS (SELECT split, window_id, z[1:{block}] AS x, z[2:{block + 1}] AS y,
                  coalesce(list_position(z[1:{block}], 257), 0) AS p FROM cut),
windows AS (SELECT split, window_id, x, CASE WHEN ({masked}) AND p > 0
              THEN list_transform(y, lambda v, i: CASE WHEN i >= p THEN -100 ELSE v END) ELSE y END AS y FROM halves),
digests AS (SELECT split, window_id, md5(array_to_string(x, ',')) AS x, md5(array_to_string(y, ',')) AS y FROM windows)
"""


_WS = r"\s\x0b\x85\p{Z}"
# the split pattern without look-ahead and possessive forms: U+0001 marks the last white space of a run
_CHUNKS = rf"""
marked AS (SELECT doc_id, regexp_replace(text, '([\t\x0b\x0c \x85\p{{Z}}])([^{_WS}])', chr(1) || '\1\2', 'g') AS text
           FROM documents),
chunks AS (SELECT doc_id, i, chunk FROM (
  SELECT doc_id, unnest(c) AS chunk, generate_subscripts(c, 1) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '(?i:''(?:[sdmt]|ll|ve|re))|[^\r\n\p{{L}}\p{{N}}\x01]?\p{{L}}+|\p{{N}}{{1,2}}| ?[^{_WS}\p{{L}}\p{{N}}\x01]+[\r\n]*|[{_WS}]*[\r\n]|[{_WS}]+') AS c
    FROM marked)))
"""


def _merges_sql(merges: int) -> str:
    """Sequential merges: one row per step and chunk, states as lists of ids in a text of characters."""
    return f"""WITH RECURSIVE {_CHUNKS},
freq AS (SELECT chunk, count(*) AS freq FROM chunks GROUP BY chunk),
bytes AS (SELECT chunk, freq, array_to_string(list_transform(regexp_extract_all(hex(encode(chunk)), '..'),
             lambda h: chr(('0x' || h)::INT + 1)), '') AS s FROM freq),
steps AS (
  SELECT 0 AS step, chunk, freq, s, NULL::VARCHAR AS pair, NULL::BIGINT AS pair_freq FROM bytes
  UNION ALL
  SELECT step + 1, chunk, freq, replace(s, best.pair, chr(256 + step + 1)), best.pair, best.n::BIGINT
  FROM (SELECT * FROM steps) AS now, (
    SELECT pair, sum(freq) AS n FROM (
      SELECT freq, unnest(list_transform(range(1, length(s)), lambda i: substr(s, i, 2))) AS pair FROM steps)
    GROUP BY pair ORDER BY n DESC, unicode(pair), unicode(substr(pair, 2)) LIMIT 1) AS best
  WHERE step < {merges}),
merges AS (SELECT DISTINCT step, unicode(pair) - 1 AS left_id, unicode(substr(pair, 2)) - 1 AS right_id, pair_freq
           FROM steps WHERE step > 0)
"""


_LEARNED = f"""{_merges_sql(20)},
final AS (SELECT chunk, list_transform(range(1, length(s) + 1), lambda j: unicode(substr(s, j, 1)) - 1) AS ids
          FROM steps WHERE step = 20),
joined AS (SELECT doc_id, list(ids ORDER BY i) AS ids FROM chunks JOIN final USING (chunk) GROUP BY doc_id),
whole AS (SELECT doc_id, list_concat([278], flatten(ids), [277]) AS ids FROM joined)
"""


def own_sql() -> dict[str, str]:
    stats = """count(*) AS examples, sum(token_len)::BIGINT AS tokens,
       min(char_len)::DOUBLE AS char_min, max(char_len)::DOUBLE AS char_max, round(sum(char_len)::DOUBLE / count(*), 6) AS char_mean,
       min(token_len)::DOUBLE AS token_min, max(token_len)::DOUBLE AS token_max, round(sum(token_len)::DOUBLE / count(*), 6) AS token_mean"""
    digest = "md5(array_to_string(ids, ',')) AS ids"
    batches = f"""{_windows_sql(BLOCK, BLOCK, "split = 'validation'")},
            counted AS (SELECT *, count(*) OVER (PARTITION BY split) AS n FROM digests)
            SELECT split, window_id // {BATCH} AS batch_id, (window_id % {BATCH})::INT AS row_in_batch, window_id, x, y FROM counted
            WHERE split <> 'train' OR window_id // {BATCH} < n // {BATCH}"""
    by_source = f"""WITH encoded AS (SELECT source AS split, doc_id, '' AS order_key, length(text) AS char_len,
                    octet_length(encode(text)) + 2 AS token_len FROM documents WHERE text <> ''), {_OFFSETS}"""
    plain = f"""WITH encoded AS (SELECT doc_id, length(text) AS char_len, octet_length(encode(text)) + 2 AS token_len,
                {_IDS} AS ids FROM documents WHERE text <> '')"""
    turns = f"""WITH encoded AS (SELECT conv_id, turn, {_IDS} AS ids FROM conversations WHERE text <> '')"""
    accumulate, steps = STEPS.accumulate_grad_batches, STEPS.max_steps
    warmup = round(STEPS.warmup_ratio * steps)
    floor = STEPS.min_lr / STEPS.learning_rate
    sizes = f"""sizes AS (SELECT total, (total - {BLOCK + 1}) // {STRIDE} + 1 AS windows,
                 ((total - {BLOCK + 1}) // {STRIDE} + 1) // {BATCH} AS batches FROM placed WHERE split = 'train' LIMIT 1),
per_pass AS (SELECT *, (batches + {accumulate - 1}) // {accumulate} AS steps_per_pass FROM sizes)"""
    plan = f"""{sizes},
plan AS (SELECT step::INT AS step, (step // steps_per_pass)::INT AS epoch, step % steps_per_pass * {accumulate} AS first_batch,
                least(step % steps_per_pass * {accumulate} + {accumulate}, batches) - 1 AS last_batch
         FROM range({steps}) t(step), per_pass)"""
    log = """WITH log AS (SELECT user_id AS run_id, event_id AS step, ts, length(props) AS n_tokens FROM events),
all_rows AS (SELECT *, sum(n_tokens) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS so_far FROM log),
logged AS (SELECT *, lag(ts) OVER w AS ts_before, lag(so_far) OVER w AS so_far_before FROM all_rows
           WHERE (step + 1) % 3 = 0 WINDOW w AS (PARTITION BY run_id ORDER BY step)),
emitted AS (SELECT *, (epoch_us(ts) - epoch_us(ts_before)) / 1e6 AS elapsed FROM logged WHERE ts > ts_before)"""
    bigrams = f"""bigrams AS (SELECT a, b, count(*) AS n FROM (
  SELECT unnest(ids[1:len(ids)-1]) AS a, unnest(ids[2:len(ids)]) AS b FROM encoded) GROUP BY a, b)"""
    losses = f"""{_windows_sql(BLOCK, BLOCK, "split = 'validation'")},
bigrams AS (SELECT a, b, count(*) AS n FROM (
  SELECT unnest(ids[1:len(ids)-1]) AS a, unnest(ids[2:len(ids)]) AS b FROM encoded WHERE split = 'train') GROUP BY a, b),
lefts AS (SELECT a, sum(n) AS n_left FROM bigrams GROUP BY a),
targets AS (SELECT window_id // {BATCH} AS batch_id, unnest(x) AS a, unnest(y) AS b FROM windows WHERE split = 'validation'),
scored AS (SELECT batch_id, t.b, ln((coalesce(n, 0) + 1.0::DOUBLE) / (coalesce(n_left, 0) + 260.0::DOUBLE)) AS logp
           FROM targets t LEFT JOIN bigrams USING (a, b) LEFT JOIN lefts USING (a)),
losses AS (SELECT batch_id, count(*) FILTER (b <> -100) AS n_targets, avg(-logp) FILTER (b <> -100) AS loss
           FROM scored GROUP BY batch_id)"""
    cut = f"""{plain}, {bigrams},
ranked AS (SELECT a, b, n, sum(n) OVER (PARTITION BY a) AS total,
                  coalesce(sum(n) OVER (PARTITION BY a ORDER BY n DESC, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
           FROM bigrams),
kept AS (SELECT *, sum(n) OVER (PARTITION BY a) AS kept_total FROM ranked WHERE before::DOUBLE / total <= 0.91373)"""
    return {
        "corpus_scan": "SELECT 'train' AS split, doc_id, md5(text) AS text_md5, false AS existing_validation FROM documents",
        "length_filter": "SELECT doc_id, length(text)::INT AS char_len FROM documents WHERE length(text) BETWEEN 10 AND 20000",
        "drop_empty": """SELECT doc_id, length(digits)::INT AS char_len
            FROM (SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits FROM documents) WHERE digits <> ''""",
        "filter_report": """SELECT source AS split, count(*) AS original, count(*) FILTER (length(text) >= 10) AS kept,
            count(*) FILTER (length(text) < 10) AS removed, count(*) FILTER (text IS NULL) AS null_texts,
            count(*) FILTER (text = '') AS empty_texts FROM documents GROUP BY source""",
        "holdout_split": f"WITH {_HELD_OUT} SELECT doc_id, split, order_key FROM held_out",
        "pretokenize_counts": f"WITH {_CHUNKS} SELECT chunk, count(*) AS freq FROM chunks GROUP BY chunk",
        "byte_pair_counts": f"""WITH {_CHUNKS},
            freq AS (SELECT chunk, count(*) AS freq FROM chunks GROUP BY chunk),
            bytes AS (SELECT freq, list_transform(regexp_extract_all(hex(encode(chunk)), '..'), lambda h: ('0x' || h)::INT) AS b FROM freq)
            SELECT left_id, right_id, sum(freq)::BIGINT AS pair_freq FROM (
              SELECT freq, unnest(b[1:len(b)-1]) AS left_id, unnest(b[2:len(b)]) AS right_id FROM bytes WHERE len(b) > 1)
            GROUP BY left_id, right_id""",
        "bpe_vocab": f"""{_merges_sql(40)},
            spelled AS (SELECT step AS id, left_id, right_id FROM merges),
            expand AS (
              SELECT i::INT AS token_id, printf('%02X', i) AS bytes FROM range(256) r(i)
              UNION ALL
              SELECT (255 + m.id)::INT, (SELECT string_agg(printf('%02X', 0), '') FROM range(0)) FROM spelled m WHERE false),
            texts AS (SELECT DISTINCT step, s, chunk FROM steps),
            found AS (
              SELECT m.step, hex(encode(t.chunk)) AS chunk_hex, t.s, strpos(t.s, chr(256 + m.step)) AS at
              FROM merges m JOIN texts t ON t.step = m.step AND strpos(t.s, chr(256 + m.step)) > 0),
            widths AS (
              WITH RECURSIVE w AS (
                SELECT 0 AS step, map_from_entries(list({{'k': i::INT, 'v': 1}})) AS m FROM range(256) r(i)
                UNION ALL
                SELECT w.step + 1, map_concat(w.m, MAP {{(255 + w.step + 1)::INT: w.m[merges.left_id] + w.m[merges.right_id]}})
                FROM w JOIN merges ON merges.step = w.step + 1)
              SELECT m FROM w ORDER BY step DESC LIMIT 1),
            learned AS (
              SELECT f.step, min(substr(f.chunk_hex, 2 * coalesce(list_sum(list_transform(range(1, f.at),
                       lambda j: w.m[(unicode(substr(f.s, j, 1)) - 1)::INT])), 0)::BIGINT + 1,
                       2 * w.m[(255 + f.step)::INT])) AS bytes
              FROM found f, widths w GROUP BY f.step)
            SELECT token_id, bytes, NULL::INT AS left_id, NULL::INT AS right_id, NULL::BIGINT AS pair_freq,
                   false AS is_special, NULL::VARCHAR AS name FROM expand
            UNION ALL
            SELECT (255 + m.step)::INT, l.bytes, m.left_id, m.right_id, m.pair_freq, false, NULL
            FROM merges m JOIN learned l USING (step)
            UNION ALL
            SELECT (295 + i)::INT, hex(encode(name)), NULL, NULL, NULL, true, name
            FROM (VALUES (1, '<pad>'), (2, '<eos>'), (3, '<bos>'), (4, '<unk>')) v(i, name)""",
        "bpe_report": f"""{_merges_sql(4)}
            SELECT (256 + count(*) + 4)::INT AS vocab_size, count(*)::INT AS merges, '<pad> <eos> <bos> <unk>' AS special_tokens FROM merges""",
        "encode_documents": f"{plain} SELECT doc_id, char_len::INT AS char_len, token_len::INT AS token_len, {digest} FROM encoded",
        "encode_learned": f"""{_LEARNED}
            SELECT doc_id, length(text)::INT AS char_len, len(ids)::INT AS token_len, {digest} FROM whole JOIN documents USING (doc_id)""",
        "encode_roundtrip": "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE text <> ''",
        "roundtrip_report": """SELECT count(*) AS documents, 0::BIGINT AS mismatches
            FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark) WHERE text <> ''""",
        "corpus_stats": f"WITH {_ENCODED} SELECT split, {stats} FROM encoded GROUP BY split",
        "corpus_metadata": f"""WITH {_ENCODED}, s AS (SELECT split, {stats} FROM encoded GROUP BY split),
            t AS (SELECT * FROM s WHERE split = 'train'), v AS (SELECT * FROM s WHERE split = 'validation')
            SELECT 260 AS vocab_size, 258 AS bos_token_id, 257 AS eos_token_id, 256 AS pad_token_id, 259 AS unk_token_id,
                   'uint16' AS dtype, t.tokens AS train_tokens, v.tokens AS val_tokens, t.examples AS train_examples,
                   v.examples AS val_examples, false AS used_existing_split, {FRACTION}::DOUBLE AS val_split, {SEED}::BIGINT AS seed,
                   {", ".join(f"{a}.{u}_{w} AS {n}_{u}_{w}" for a, n in (("t", "train"), ("v", "val")) for u in ("char", "token") for w in ("min", "max", "mean"))}
            FROM t, v""",
        "token_offsets": f'{_STREAM} SELECT split, doc_id, "offset", token_len::INT AS token_len FROM placed',
        "token_offsets_by_source": f'{by_source} SELECT split, doc_id, "offset", token_len::INT AS token_len FROM placed',
        "token_prefix": f"""{_STREAM}, limits(split, n) AS (VALUES ('train', 100000), ('validation', 10000)),
            kept AS (SELECT split, doc_id, "offset", ids[1:n - "offset"] AS ids FROM placed JOIN limits USING (split) WHERE "offset" < n)
            SELECT split, doc_id, "offset", len(ids)::INT AS token_len, {digest} FROM kept""",
        "train_windows": f"{_windows_sql(BLOCK, STRIDE, 'false')} SELECT * FROM digests WHERE split = 'train'",
        "windows_masked": f"""{_windows_sql(BLOCK, BLOCK, "split = 'validation'")} SELECT * FROM digests""",
        "window_counts": f"""{by_source} SELECT split, sum(token_len)::BIGINT AS n_tokens,
            ((sum(token_len)::BIGINT - {BLOCK + 1}) // {STRIDE} + 1)::BIGINT AS windows FROM placed GROUP BY split""",
        "window_lookup": f"""{_windows_sql(BLOCK, STRIDE, "split = 'validation'")} SELECT * FROM digests WHERE window_id BETWEEN 3 AND 40""",
        "batches": batches,
        "token_budget": f"""{_STREAM}, sizes AS (SELECT DISTINCT split, total, (total - {BLOCK + 1}) // {STRIDE} + 1 AS windows FROM placed)
            , counted AS (SELECT *, (windows + CASE WHEN split = 'train' THEN 0 ELSE {BATCH - 1} END) // {BATCH} AS batches FROM sizes)
            SELECT split, total AS n_tokens, windows, batches,
                   (batches + {accumulate - 1}) // {accumulate} AS steps_per_pass, {BATCH * accumulate}::BIGINT AS effective_batch_size,
                   {BATCH * BLOCK}::BIGINT AS tokens_per_batch, {BATCH * BLOCK * accumulate}::BIGINT AS tokens_per_step FROM counted""",
        "step_plan": f"""{_STREAM}, {plan}
            SELECT step, epoch, first_batch, last_batch, (last_batch - first_batch + 1) * {BATCH} AS n_windows,
                   (last_batch - first_batch + 1) * {BATCH * BLOCK} AS n_tokens,
                   round({STEPS.learning_rate}::DOUBLE * CASE WHEN step < {warmup} THEN step::DOUBLE / {warmup}
                     ELSE {floor!r}::DOUBLE + (1 - {floor!r}::DOUBLE) * 0.5::DOUBLE * (1 + cos(pi() * least(1.0::DOUBLE, (step - {warmup})::DOUBLE / {steps - warmup}))) END, 12) AS lr
            FROM plan""",
        "order_manifest": f"""{_STREAM}, {plan},
            pieces AS (SELECT doc_id, "offset", token_len, unnest(range(greatest(0, ("offset" - {BLOCK} + {STRIDE - 1}) // {STRIDE}),
                         least((total - {BLOCK + 1}) // {STRIDE}, ("offset" + token_len - 1) // {STRIDE}) + 1)) AS w
                       FROM placed WHERE split = 'train'),
            read AS (SELECT w // {BATCH * accumulate} AS pass_step, doc_id,
                            least("offset" + token_len, w * {STRIDE} + {BLOCK + 1}) - greatest("offset", w * {STRIDE}) AS n
                     FROM pieces, sizes WHERE w < batches * {BATCH}),
            per_step AS (SELECT pass_step, count(DISTINCT doc_id) AS n_documents, min(doc_id) AS min_doc_id, max(doc_id) AS max_doc_id,
                                sum(n)::BIGINT AS tokens_read FROM read GROUP BY pass_step)
            SELECT step, epoch, n_documents, min_doc_id, max_doc_id, tokens_read
            FROM plan JOIN per_step ON pass_step = first_batch // {accumulate}""",
        "prompts": f"""WITH encoded AS (SELECT conv_id, turn, {_IDS} AS whole FROM conversations),
            opened AS (SELECT conv_id, turn, whole[1:len(whole)-1] AS prompt FROM encoded),
            kept AS (SELECT conv_id, turn, prompt[greatest(1, len(prompt) - 127):] AS ids FROM opened)
            SELECT conv_id, turn, len(ids)::INT AS n_ids, {digest} FROM kept""",
        "cut_at_eos": f"""{turns}, twice AS (SELECT conv_id, turn, list_concat(ids, ids)[1:400] AS ids FROM encoded),
            kept AS (SELECT conv_id, turn, ids[1:coalesce(nullif(list_position(ids, 257), 0), len(ids))] AS ids FROM twice)
            SELECT conv_id, turn, len(ids)::INT AS n_ids, {digest} FROM kept""",
        "throughput": f"""{log} SELECT run_id, step, round((so_far - so_far_before)::DOUBLE / elapsed, 9) AS tokens_per_sec,
            so_far::BIGINT AS tokens_processed FROM emitted""",
        "throughput_sampled": f"""{log} SELECT run_id, step, round(n_tokens::DOUBLE / elapsed, 9) AS tokens_per_sec,
            (sum(n_tokens) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING))::BIGINT AS tokens_processed FROM emitted""",
        "masked_loss": f"{losses} SELECT batch_id, n_targets, round(loss, 6) AS loss, round(exp(loss), 5) AS perplexity FROM losses",
        "validation_loss": f"""{losses}, sizes AS (SELECT window_id // {BATCH} AS batch_id, count(*) AS n_rows FROM windows
            WHERE split = 'validation' GROUP BY ALL)
            SELECT count(loss) AS batches, round(sum(loss * n_rows) / sum(n_rows), 6) AS val_loss,
                   round(sum(exp(loss) * n_rows) / sum(n_rows), 5) AS val_ppl
            FROM losses JOIN sizes USING (batch_id) WHERE loss IS NOT NULL""",
        "softmax": f"""{plain}, {bigrams}
            SELECT a AS group_id, b AS item_id, round((n::DOUBLE * n) / sum(n::DOUBLE * n) OVER (PARTITION BY a), 9) AS p FROM bigrams""",
        "top_p": f"{cut} SELECT a AS group_id, b AS item_id, round(n::DOUBLE / kept_total, 9) AS p FROM kept",
        "argmax": f"{plain}, {bigrams} SELECT a AS group_id, arg_max(b, n * 1000 - b) AS item_id FROM bigrams GROUP BY a",
        "weighted_draw": f"""{cut}, u AS (SELECT *, ('0x' || substr(md5('{SEED}:' || a), 1, 13))::BIGINT / {float(1 << 52)!r}::DOUBLE AS u FROM kept)
            SELECT a AS group_id, arg_max(b, before) AS item_id FROM u WHERE before::DOUBLE / kept_total <= u GROUP BY a""",
        "token_bin_roundtrip": f"""{_STREAM}, tokens AS (SELECT split, "offset" + i AS pos1, token FROM (
              SELECT split, "offset", unnest(ids) AS token, generate_subscripts(ids, 1) AS i FROM placed))
            SELECT split, count(*) AS n_tokens, sum(token)::BIGINT AS token_sum, sum(pos1 * token)::BIGINT AS weighted_sum FROM tokens GROUP BY split""",
        "token_bin_manifest": f"{_STREAM} SELECT split, sum(token_len)::BIGINT AS n_tokens FROM placed GROUP BY split",
        "token_bin_windows": f"""{_windows_sql(BLOCK, BLOCK, "split = 'validation'")} SELECT * FROM digests""",
        "token_bin_prefix": f"""{_STREAM}, tokens AS (SELECT "offset" + i AS pos1, token FROM (
              SELECT split, "offset", unnest(ids) AS token, generate_subscripts(ids, 1) AS i FROM placed WHERE split = 'train'))
            SELECT count(*) AS n_tokens, sum(token)::BIGINT AS token_sum, sum(pos1 * token)::BIGINT AS weighted_sum
            FROM tokens WHERE pos1 <= 100000""",
        "token_bin_window_lookup": f"""{_windows_sql(BLOCK, STRIDE, "false")}
            SELECT * FROM digests WHERE split = 'train' AND window_id BETWEEN 3 AND 40""",
        "corpus_scan_splits": """SELECT CASE WHEN lang = 'en' THEN 'validation' ELSE 'train' END AS split, doc_id, md5(text) AS text_md5,
            true AS existing_validation FROM documents""",
        "tokenized_table": f"""WITH {_ENCODED} SELECT split, doc_id, char_len::INT AS char_len, token_len::INT AS token_len, {digest}
            FROM encoded""",
        "stream_encode": f"""{plain} SELECT doc_id, char_len::INT AS char_len, token_len::INT AS token_len, {digest}
            FROM encoded WHERE char_len >= 10""",
        "stream_stats": f"""WITH encoded AS (SELECT source AS split, length(text) AS char_len, octet_length(encode(text)) + 2 AS token_len
            FROM documents WHERE text <> '') SELECT split, {stats} FROM encoded GROUP BY split""",
        "stream_throughput": """WITH rows AS (SELECT (epoch_us(ts) // 86400000000) * 86400 AS window_start, user_id AS run_id,
                length(props) AS n_tokens, max(epoch_us(ts)) OVER () AS latest FROM events)
            SELECT window_start, run_id, count(*) AS steps, sum(n_tokens)::BIGINT AS n_tokens,
                   round(sum(n_tokens)::DOUBLE / 86400, 9) AS tokens_per_sec FROM rows
            WHERE (window_start + 86400) * 1000000 <= latest - 3600000000 GROUP BY ALL""",
        "stream_windows": f"""{_windows_sql(BLOCK, STRIDE, 'true', _ARRIVED)} SELECT * FROM digests""",
        "stream_windows_by_source": f"""{_windows_sql(BLOCK, STRIDE, 'true', _ARRIVED.replace("'train' AS split", "source AS split"))} SELECT * FROM digests""",
        "training_batches": batches,
        "learned_windows": f"""{_windows_sql(BLOCK, STRIDE, 'false', f"""{_LEARNED},
            encoded AS (SELECT 'train' AS split, doc_id, '' AS order_key, len(ids) AS token_len, ids FROM whole), {_OFFSETS}""")} SELECT * FROM digests""",
        "bpe_merges_512": f"""{_merges_sql(252)}
            SELECT (255 + step)::INT AS token_id, left_id::INT AS left_id, right_id::INT AS right_id, pair_freq FROM merges""",
        "token_bin_append": f"""{_ARRIVED}
            SELECT token, count(*) AS n FROM (SELECT unnest(ids) AS token FROM encoded) GROUP BY token""",
        "token_bin_arriving_windows": f"""{_ARRIVED}
            SELECT unnest(range(0, (total - {BLOCK + 1}) // {STRIDE} + 1)) AS window_id, {BLOCK}::INT AS n_inputs, {BLOCK}::INT AS n_targets
            FROM (SELECT sum(token_len)::BIGINT AS total FROM encoded)""",
    }
