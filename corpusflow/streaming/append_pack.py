"""Continuing a token stream: each micro-batch appends documents and yields only the new windows.

State between batches is how many tokens there are and the tail that no window has used up yet, at
most ``block_size`` tokens.  It is written per batch id, and a batch reads the state of the batch
before it, so a batch that is run again writes the same windows again in the same place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.functions.ordering import with_id_order
from corpusflow.operators.codec import encode
from corpusflow.operators.stream import TokenStream, token_offsets
from corpusflow.operators.vocabulary import Vocabulary
from corpusflow.operators.windows import pack_windows
from corpusflow.storage import drop_table, write_table

STATE = "n_tokens BIGINT, tail ARRAY<INT>"


class AppendPacker:
    """Windows of an append-only corpus; documents of a batch are taken in id order."""

    def __init__(self, vocab: Vocabulary, target: str, block_size: int, stride: int, split: str = "train", mask: bool = False) -> None:
        self.vocab, self.target, self.split = vocab, target.rstrip("/"), split
        self.block_size, self.stride, self.mask = block_size, stride, mask

    def windows_of(self, n_tokens: int) -> int:
        return max(0, n_tokens - self.block_size - 1 + self.stride) // self.stride

    def _state_before(self, spark: SparkSession, batch_id: int) -> tuple[int, list[int]]:
        if batch_id == 0:
            return 0, []
        state = spark.read.schema(STATE).parquet(f"{self.target}/state/batch_id={batch_id - 1}").first()
        return state.n_tokens, state.tail

    def __call__(self, documents: DataFrame, batch_id: int) -> None:
        spark = documents.sparkSession
        n_before, tail = self._state_before(spark, batch_id)
        rows = encode(documents.select("doc_id", "text"), self.vocab).withColumn("split", F.lit(self.split))
        encoded, path = write_table(with_id_order(rows), "append")
        arrived = token_offsets(encoded)
        n_after = n_before + arrived.totals.get(self.split, 0)
        columns = ["split", "bucket", "bucket_start", "bucket_end", "offset", "token_len", "ids"]
        segments = arrived.segments
        for name in ("bucket_start", "bucket_end", "offset"):
            segments = segments.withColumn(name, F.col(name) + n_before)
        kept = spark.createDataFrame(
            [(self.split, -1, n_before - len(tail), n_before, n_before - len(tail), len(tail), tail)] if tail else [],
            "split STRING, bucket INT, bucket_start BIGINT, bucket_end BIGINT, offset BIGINT, token_len INT, ids ARRAY<INT>",
        )
        segments = segments.select(*columns).unionByName(kept).withColumn("split_tokens", F.lit(n_after).cast("bigint"))
        first, stop = self.windows_of(n_before), self.windows_of(n_after)
        if first < stop:
            windows = pack_windows(
                TokenStream(segments, {self.split: n_after}),
                self.block_size,
                self.stride,
                self.vocab.eos_id,
                [self.split] if self.mask else [],
                (first, stop - 1),
            )
            windows.write.mode("overwrite").parquet(f"{self.target}/windows/batch_id={batch_id}")
        start = F.lit(stop * self.stride)
        left = segments.where(F.col("offset") + F.col("token_len") > start).select(
            "offset", F.slice("ids", (F.greatest(start - F.col("offset"), F.lit(0)) + 1).cast("int"), F.col("token_len")).alias("ids")
        )
        tail = [token for row in left.orderBy("offset").collect() for token in row.ids]  # at most block_size tokens
        state = spark.createDataFrame([(n_after, tail)], STATE)
        state.write.mode("overwrite").parquet(f"{self.target}/state/batch_id={batch_id}")
        drop_table(spark, path)

    def start(self, documents: DataFrame, checkpoint: str) -> StreamingQuery:
        return (
            documents.writeStream.foreachBatch(self)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.target}/windows").drop("batch_id")
