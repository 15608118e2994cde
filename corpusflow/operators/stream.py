"""One ordered token stream per split: where every document starts.

Documents are laid end to end in their total order.  The running sum is taken in two steps: ranges of neighbouring
documents with about equal numbers of tokens come first (``corpusflow.operators.ranges``), then each range, a bucket, sums its
own documents.  No window runs over a whole split, and token arrays are shuffled once, by ``(split, bucket)``; cutting
windows later reuses that placement.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.ordering import ORDER_COLUMNS
from corpusflow.operators.ranges import cut_ranges

#: Tokens a bucket should hold: enough that few windows cross buckets, little enough for one task.
TOKENS_PER_BUCKET = 16 << 20


@dataclass
class TokenStream:
    """Token arrays with their global offsets.

    ``segments``: ``split, bucket, bucket_start, bucket_end, split_tokens, offset, token_len, ids, ...``
    ``totals``: tokens per split.  ``buckets``: ``split, bucket, bucket_start, bucket_end`` as a table.
    """

    segments: DataFrame
    totals: dict[str, int]
    buckets: DataFrame | None = None

    def between(self, ranges: dict[str, tuple[int, int]]) -> DataFrame:
        """Segments of the buckets that overlap the token range ``[low, high)`` of each named split.

        Whole buckets are left out by where they start and end, which happens before token arrays are shuffled.
        """
        wanted: Column = F.lit(False)
        for split, (low, high) in ranges.items():
            wanted = wanted | ((F.col("split") == split) & (F.col("bucket_start") < high) & (F.col("bucket_end") > low))
        return self.segments.where(wanted)


def token_offsets(encoded: DataFrame, tokens_per_bucket: int = TOKENS_PER_BUCKET) -> TokenStream:
    """Lay ``encoded`` documents end to end, per split.

    ``encoded`` has ``split, doc_id, order_key, order_pos, token_len`` and any further columns, which
    are kept.  It is read several times, so it should be a written table; the first reads touch only
    the order and length columns.  Documents that share their place in the order are laid out by length, then by
    content, if there is ``ids``.
    """
    spark = encoded.sparkSession
    ranges = cut_ranges(encoded, tokens_per_bucket, 4 * spark.sparkContext.defaultParallelism)
    last = ["token_len", F.xxhash64("ids").bitwiseAND(F.lit(2**63 - 1))] if "ids" in encoded.columns else ["token_len"]
    # a filter on where buckets start and end passes below a window that is parted by these as well
    within = Window.partitionBy("split", "bucket", "bucket_start", "bucket_end").orderBy(*ORDER_COLUMNS, *last)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    # as many partitions as the tokens ask for, whatever the session's default
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(ranges.totals.values()) // tokens_per_bucket)
    segments = (
        ranges.assign(encoded)
        .repartition(partitions, "split", "bucket")
        .withColumn("offset", F.col("bucket_start") + F.coalesce(F.sum("token_len").over(before), F.lit(0)))
    )
    return TokenStream(segments, ranges.totals, ranges.table.select("split", "bucket", "bucket_start", "bucket_end"))


def token_prefix(stream: TokenStream, limits: dict[str, int] | int) -> DataFrame:
    """The first tokens of each split; the last document may be cut, a short split stays as it is.

    ``limits`` is one number for all splits or a number per split (splits not named are left out).
    """
    if isinstance(limits, int):
        limits = dict.fromkeys(stream.totals, limits)
    if any(limit < 0 for limit in limits.values()):
        raise ValueError("a token limit must not be negative")
    limit: Column = F.lit(None).cast("bigint")
    for split, count in limits.items():
        limit = F.when(F.col("split") == split, F.lit(count).cast("bigint")).otherwise(limit)
    keep = F.least(F.col("token_len").cast("bigint"), F.col("limit") - F.col("offset")).cast("int")
    return (
        stream.between({split: (0, count) for split, count in limits.items()})
        .withColumn("limit", limit)
        .where(F.col("offset") < F.col("limit"))
        .withColumn("token_len", keep)
        .withColumn("ids", F.slice("ids", F.lit(1), F.col("token_len")))
        .drop("limit", "bucket", "bucket_start", "bucket_end", "split_tokens")
    )
