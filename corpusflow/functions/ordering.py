"""Total orders over documents.

A DataFrame has no order, so every ordered operator sorts by ``(order_pos, order_key, doc_id)``.
``order_pos`` is a 64-bit number that never decreases along the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER_COLUMNS = ("order_pos", "order_key", "doc_id")


def hash_key(seed: int, doc_id: Column | str = "doc_id") -> Column:
    """Seeded, uniformly spread sort key of a document."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.md5(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"))


def hash_position(key: Column) -> Column:
    """First 60 bits of a hexadecimal key as a number with the same order."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")


def with_hash_order(df: DataFrame, seed: int, doc_id: str = "doc_id") -> DataFrame:
    """Seeded shuffle order."""
    key = hash_key(seed, doc_id)
    return df.withColumn("order_key", key).withColumn("order_pos", hash_position(F.col("order_key")))


def with_id_order(df: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The order in which documents are stored, i.e. by id."""
    return df.withColumn("order_key", F.lit("")).withColumn("order_pos", F.col(doc_id).cast("bigint"))
