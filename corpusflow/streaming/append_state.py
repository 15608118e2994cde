"""Continuing many token streams at once, with the state of each kept by Spark.

State is, per split, how many tokens there were and the tail that no window has used up yet, fewer than ``block_size +
stride`` tokens.  It lives in the state store of the query, so a restart goes on from the checkpoint and nothing passes through the driver.
A task holds the documents of one split and micro-batch, so ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds it; for single
splits with large batches ``corpusflow.streaming.append_pack`` spreads each batch over the cluster instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpusflow.operators.codec import encode
from corpusflow.operators.vocabulary import Vocabulary
from corpusflow.operators.windows import shift_targets
from corpusflow.sources.config import check_window_arguments

STATE = "n_tokens BIGINT, tail ARRAY<INT>"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Tokens of windows that are handed over at once.
TOKENS_AT_ONCE = 1 << 20


class WindowCutter(StatefulProcessor):
    """Windows of each split as they become whole; documents of a micro-batch are taken in id order."""

    def __init__(self, block_size: int, stride: int) -> None:
        self.block_size, self.stride = block_size, stride

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("stream", STATE)

    def windows_of(self, n_tokens: int) -> int:
        return max(0, n_tokens - self.block_size - 1 + self.stride) // self.stride

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        n_before, tail = self.state.get() if self.state.exists() else (0, [])
        documents = pd.concat(rows).sort_values("doc_id", kind="stable")
        tokens = np.concatenate([np.asarray(part, np.int32) for part in [tail, *documents["ids"]]])
        begin = n_before - len(tail)
        n_after = begin + len(tokens)
        first, stop = self.windows_of(n_before), self.windows_of(n_after)
        self.state.update((n_after, tokens[stop * self.stride - begin :].tolist()))
        step = max(1, TOKENS_AT_ONCE // (self.block_size + 1))
        for low in range(first, stop, step):
            ids = range(low, min(low + step, stop))
            cut = [tokens[w * self.stride - begin : w * self.stride - begin + self.block_size + 1] for w in ids]
            yield pd.DataFrame({"split": key[0], "window_id": list(ids), "tokens": cut})

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """State of this kind needs a store that can hold it; a query keeps what was set when it started."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def continued_windows(
    documents: DataFrame, vocab: Vocabulary, block_size: int, stride: int, masked: bool = False
) -> DataFrame:
    """``split, window_id, x, y`` of arriving ``documents`` (``split, doc_id, text``), each window once.

    ``window_id`` counts the windows of a split from its first document on, over all micro-batches.
    """
    check_window_arguments(block_size, stride)
    encoded = encode(documents.select("split", "doc_id", "text"), vocab).select("split", "doc_id", "ids")
    windows = encoded.groupBy("split").transformWithStateInPandas(
        statefulProcessor=WindowCutter(block_size, stride),
        outputStructType="split STRING, window_id BIGINT, tokens ARRAY<INT>",
        outputMode="Append",
        timeMode="None",
    )
    return shift_targets(windows, block_size, vocab.eos_id, F.lit(True) if masked else None)


def append_windows(windows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Add the windows of :func:`continued_windows` to a parquet folder, each exactly once across restarts."""
    with _rocksdb(windows.sparkSession):
        return (
            windows.writeStream.format("parquet").outputMode("append").option("path", target)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
