"""The whole way from a configured corpus to a vocabulary, token files and subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusflow.functions.ordering import with_id_order
from corpusflow.operators.bpe import TrainingRun, chunk_freq, learn_merges
from corpusflow.operators.codec import encode
from corpusflow.operators.filters import filter_report
from corpusflow.operators.split import holdout_split
from corpusflow.operators.stats import corpus_metadata
from corpusflow.operators.stream import TokenStream, token_offsets
from corpusflow.operators.vocabulary import Vocabulary
from corpusflow.operators.windows import batch, window_count
from corpusflow.sources.config import CorpusConfig, TokenizerConfig, WindowConfig, load_mapping
from corpusflow.sources.corpus import read_corpus, resolve_splits, save_vocabulary, write_metadata, write_tokenized
from corpusflow.sources.token_bin import copy_prefix, read_windows, token_count, write_stream
from corpusflow.storage import spread_small


def corpus_report(spark: SparkSession, config: CorpusConfig, min_length: int = 10) -> DataFrame:
    """Rows of every split before and after the length filter."""
    return filter_report(read_corpus(spark, config), min_length)


def train_tokenizer(spark: SparkSession, config: TokenizerConfig) -> TrainingRun:
    """Learn merges on the physical split called ``train`` and store vocabulary and report."""
    corpus = read_corpus(spark, CorpusConfig(**load_mapping(config.dataset_config)))
    texts = spread_small(corpus.where("split = 'train'").select("text"))
    run = learn_merges(chunk_freq(texts), config.vocab_size, config.special_tokens)
    save_vocabulary(run.vocab, run.report(spark), config.output_dir)
    return run


def split_and_encode(
    corpus: DataFrame, existing: bool, vocab: Vocabulary, val_split: float, seed: int
) -> DataFrame:
    """Encoded documents with their split and their place in it: stored order for splits that exist,
    seeded order when validation is held out of train."""
    ordered = with_id_order(corpus) if existing else holdout_split(corpus, val_split, seed)
    return encode(spread_small(ordered), vocab)


def tokenize_corpus(spark: SparkSession, config: TokenizerConfig, seed: int = 42) -> TokenStream:
    """Encode all splits, and store tokenized documents, token files and metadata."""
    vocab = Vocabulary.load(spark, f"{config.output_dir}/vocabulary")
    corpus_config = CorpusConfig(**load_mapping(config.dataset_config))
    corpus, existing = resolve_splits(read_corpus(spark, corpus_config), corpus_config)
    out = config.tokenized_output_dir
    encoded = write_tokenized(split_and_encode(corpus, existing, vocab, config.val_split, seed), f"{out}/tokenized")
    stream = token_offsets(encoded)
    write_stream(stream, f"{out}/tokens", vocab.dtype)
    write_metadata(corpus_metadata(encoded, vocab, existing, config.val_split, seed), f"{out}/metadata")
    return stream


def create_subset(spark: SparkSession, source: str, target: str, limits: dict[str, int], dtype: str = "uint16") -> None:
    """The first tokens of each named split of ``source`` as token files under ``target``."""
    for split, n_tokens in limits.items():
        copy_prefix(spark, f"{source}/{split}", f"{target}/{split}", n_tokens, dtype)


def training_batches(
    spark: SparkSession, config: WindowConfig, context_length: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Batches of train and validation windows, in reading order by ``(batch_id, row_in_batch)``.

    Train windows are not masked; ``drop_last`` concerns train only.  Validation windows are masked
    from their first EOS on.
    """
    if context_length is not None and config.block_size > context_length:
        raise ValueError(f"block_size {config.block_size} exceeds the context length {context_length}")
    views = []
    for split, path in (("train", config.train_path), ("validation", config.val_path)):
        held_out = split == "validation"
        windows = read_windows(
            spark, path, config.block_size, config.stride, config.dtype, split, config.eos_token_id, held_out
        )
        count = window_count(token_count(path, config.dtype), config.block_size, config.stride)
        dropped = [split] if config.drop_last and not held_out else []
        views.append(batch(windows, config.batch_size, {split: count}, dropped))
    return views[0], views[1]
