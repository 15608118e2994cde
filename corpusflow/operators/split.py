"""Seeded hold-out split of exact size, without moving a single text."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.ordering import with_hash_order


#: Rows of a cell that the driver sorts; larger cells are parted by the next digits of the key.
SORTED_ROWS = 1000
DIGITS = 4


def _last_held_out(ordered: DataFrame, held_out: int) -> tuple[str, int, int]:
    """Order key of the ``held_out``-th row, how many rows with that key are held out, and how many there are.

    It is found digit by digit with histograms of at most 65,536 cells.
    """
    prefix, before = "", 0
    while True:
        inside = ordered.where(F.startswith("order_key", F.lit(prefix))) if prefix else ordered
        cell = F.substring("order_key", 1, len(prefix) + DIGITS).alias("cell")
        cells = sorted((row["cell"], row["count"]) for row in inside.groupBy(cell).count().collect())
        for name, n in cells:
            if before + n >= held_out:
                break
            before += n
        if len(name) == len(prefix):  # the whole key: its rows have equal ids
            return name, held_out - before, n
        prefix = name
        if n <= SORTED_ROWS:
            keys = sorted(row[0] for row in ordered.where(F.startswith("order_key", F.lit(prefix))).select("order_key").collect())
            last = keys[held_out - before - 1]
            return last, held_out - before - keys.index(last), keys.count(last)


def holdout_split(df: DataFrame, fraction: float, seed: int = 42, doc_id: str = "doc_id") -> DataFrame:
    """Add ``split``: ``validation`` for the first ``ceil(fraction * n)`` documents in seeded order.

    The key of the last held-out document is found by counting keys alone, cell by cell.  The split itself is then a
    comparison with one literal, evaluated where the rows are.  Documents with one id are on the same side; where the cut
    falls among them, they are parted by a hash of all that they hold, so the size is exact and no partitioning changes
    the split.  NULL ids are an error, and so is a cut among rows that are equal in every column.
    """
    if not 0 < fraction < 1:
        raise ValueError(f"fraction must lie between 0 and 1, got {fraction}")
    ordered = with_hash_order(df, seed, doc_id)
    keys = ordered.select("order_key")
    total, named = keys.agg(F.count("*"), F.count("order_key")).first()
    if named < total:
        raise ValueError(f"{total - named} documents have no {doc_id}")
    held_out = math.ceil(fraction * total)
    if held_out >= total:
        raise ValueError(f"{total} documents are too few to hold out a fraction of {fraction}")
    last, part, n = _last_held_out(keys, held_out)
    inside = F.col("order_key") <= last
    if part < n:
        content = F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]))
        tie = F.md5(F.concat(F.lit(f"{seed}:"), content).cast("binary"))
        last_tie, some, equal = _last_held_out(ordered.where(F.col("order_key") == last).select(tie.alias("order_key")), part)
        if some < equal:
            raise ValueError(f"the cut falls among {equal} equal documents with one id")
        inside = (F.col("order_key") < last) | ((F.col("order_key") == last) & (tie <= last_tie))
    return ordered.withColumn("split", F.when(inside, "validation").otherwise("train"))
