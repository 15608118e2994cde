"""Cutting ordered rows into ranges of about equal weight by a weighted quantile sketch.

Each split is a cell at first.  A cell that is too heavy is cut at quantiles of its rows, found in a sample in which a
row comes as often as it has weight, about ``SAMPLES`` entries a range.  Then the weight of all parts is counted exactly, and parts
that are still too heavy are cut again, with another sample.  A cell is cut into ``FAN`` parts at most, so a sketch is
small whatever the cell weighs, and deep cells take a few rounds.

Cuts are keys of rows, all columns of the order together, so rows that share a position are parted by what
comes after it.  The range of a row depends on its key alone: it is the same in every job, whatever the partitions are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.ordering import ORDER_COLUMNS
from corpusflow.storage import drop_table, write_table

FAN, SAMPLES = 256, 64
#: Digits of a path are below this; it holds six of them.
RADIX, LEVELS = 512, 6
#: Rows of a lookup table that are broadcast, about 100 bytes each; larger tables are joined as Spark sees fit.
BROADCAST_ROWS = 500_000


def row_key(ties: bool) -> Column:
    """Sort key of a row: its place in the order, then its length, then what it holds if that is needed to tell rows apart."""
    tie = F.xxhash64("ids").bitwiseAND(F.lit(2**63 - 1)) if ties else F.lit(0).cast("bigint")
    return F.struct(*ORDER_COLUMNS, "token_len", tie.alias("tie"))


@dataclass
class Ranges:
    """``table``: ``split, path, bucket, bucket_start, bucket_end, split_tokens``, one row a range.

    ``cuts``: per level ``split, path, cuts`` of the cells that are cut there, and how many cuts these are.
    """

    table: DataFrame
    n_ranges: int
    totals: dict[str, int]
    ties: bool
    cuts: list[tuple[DataFrame, int]] = field(default_factory=list)

    def assign(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns of ``table``."""
        placed = rows.withColumns({"key": row_key(self.ties), "path": F.lit(0).cast("bigint")})
        for cuts, n in self.cuts:
            placed = _descended(placed, cuts, n)
        # said here, so that what reads the rows differently does not say it again and shuffles them once more
        table = self.table.where("bucket_start IS NOT NULL AND bucket_end IS NOT NULL")
        return placed.drop("key").join(_small(table, self.n_ranges), ["split", "path"]).drop("path")


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _descended(rows: DataFrame, cuts: DataFrame, n: int) -> DataFrame:
    """Paths one level deeper."""
    below = F.size(F.filter("cuts", lambda cut: cut <= F.col("key")))
    found = rows.join(_small(cuts, n), ["split", "path"], "left")
    return found.withColumn("path", F.col("path") * RADIX + F.coalesce(below, F.lit(0))).drop("cuts")


def _weighed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split", "path").agg(
        F.sum("token_len").cast("bigint").alias("tokens"), F.max("token_len").cast("bigint").alias("longest"), (F.min("key") < F.max("key")).alias("several")
    )


def _sketch(rows: DataFrame, heavy: DataFrame, target: int, level: int) -> DataFrame:
    """Keys at which heavy cells are cut; a row weighs no more than a range, so the cut after a long one is not far."""
    unit = F.greatest(F.col("tokens") / FAN, F.lit(float(target))) / SAMPLES
    chance = F.pmod(F.xxhash64("key", F.lit(level)), F.lit(1 << 20)) / (1 << 20)
    weight = F.least(F.col("token_len") / unit, F.lit(float(SAMPLES)))
    drawn = rows.join(heavy.select("split", "path", "tokens"), ["split", "path"])
    drawn = drawn.withColumn("entries", F.floor(weight + chance).cast("int")).where("entries > 0")
    entries = drawn.select("split", "path", F.explode(F.array_repeat("key", F.col("entries"))).alias("key"))
    keys = entries.groupBy("split", "path").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    every = F.filter(F.col("keys"), lambda _, i: (i > 0) & (i % SAMPLES == 0))
    return keys.select("split", "path", F.slice(F.array_distinct(every), 1, FAN - 1).alias("cuts")).where("size(cuts) > 0")


def cut_ranges(encoded: DataFrame, tokens_per_range: int, least_ranges: int) -> Ranges:
    """Ranges of ``encoded`` (``split``, the columns of the order, ``token_len``) with at most ``2 * tokens_per_range`` tokens.

    A longer one holds a document that is longer than ``tokens_per_range``, and little besides, or rows that are alike in
    everything.  Smaller corpora are cut into about ``least_ranges`` in all.
    """
    spark, paths = encoded.sparkSession, []

    def kept(df: DataFrame, label: str) -> DataFrame:
        table, path = write_table(df, label)
        paths.append(path)
        return table

    ties, cuts, level = False, [], 0

    def rows_at() -> DataFrame:
        rows = encoded.select("split", "token_len", row_key(ties).alias("key"), F.lit(0).cast("bigint").alias("path"))
        for table, n in cuts:
            rows = _descended(rows, table, n)
        return rows

    cells = kept(_weighed(rows_at()), "cells")
    first = cells.collect()  # one short row a split
    totals = {row["split"]: row["tokens"] for row in first}
    target = max(1, min(tokens_per_range, -(-sum(totals.values()) // least_ranges)))
    n_cells, several = len(first), [row["several"] for row in first if row["tokens"] > target < row["tokens"] - row["longest"]]
    divisible, alike = several.count(True), several.count(False)
    while level < LEVELS:
        heavy = (F.col("tokens") > (2 * target if level else target)) & (F.col("tokens") - F.col("longest") > target)
        if alike and not ties and "ids" in encoded.columns:
            ties = True
        elif not divisible:
            break
        else:
            heavy = heavy & F.col("several")
        rows, parts = rows_at(), cells.where(heavy)
        found = kept(_sketch(rows, parts, target, level), "cuts")
        cuts.append((found, found.agg(F.sum(F.size("cuts"))).first()[0] or 0))
        level += 1
        divided = _weighed(rows_at().join(found.select("split", F.col("path").alias("parent")), "split").where(F.expr(f"path div {RADIX} = parent")).drop("parent"))
        same = cells.join(found.select("split", "path"), ["split", "path"], "left_anti").withColumn("path", F.col("path") * RADIX)
        cells = kept(divided.unionByName(same), "cells")
        heavy = (F.col("tokens") > 2 * target) & (F.col("tokens") - F.col("longest") > target)
        n_cells, divisible, alike = cells.agg(F.count("*"), F.count_if(heavy & F.col("several")), F.count_if(heavy & ~F.col("several"))).first()
    along = Window.partitionBy("split").orderBy("path")
    end = F.sum("tokens").over(along)
    sizes = F.sum("tokens").over(Window.partitionBy("split"))
    table = cells.select("split", "path", (F.row_number().over(along) - 1).alias("bucket"), (end - F.col("tokens")).alias("bucket_start"), end.alias("bucket_end"), sizes.alias("split_tokens"))
    table, _ = write_table(table, "ranges")
    for path in paths:
        if "/cells-" in path:
            drop_table(spark, path)
    return Ranges(table, n_cells, totals, ties, cuts)
