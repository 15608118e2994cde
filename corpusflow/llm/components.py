"""Connected components of a link table, by alternating large and small stars.

A round hangs every node's larger neighbours on the smallest of its neighbourhood, then the smaller ones.
Every round is written, so lineage stays short and a lost executor costs one round.  Only minima are
grouped, never lists, and the joins are plain ones that Spark splits where a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.storage import drop_table, write_table


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (``a, b``, BIGINT) that is linked with another one.

    ``root`` is the smallest node of the component; the root itself has no row.  Links may repeat and may
    come in either direction; a link of a node with itself, or with null, links nothing; no links give
    no rows.
    """
    spark = links.sparkSession
    larger = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"), F.col("a").isNull() | F.col("b").isNull())
    larger = larger.toDF("node", "root", "void").where("node <> root AND NOT void").select("node", "root").distinct()
    state, path = write_table(larger, "links")
    before = _digest(state)
    while before[0]:
        state, fresh = write_table(_small_star(_large_star(state)), "links")
        drop_table(spark, path)
        path, after = fresh, _digest(state)
        if after == before:
            break
        before = after
    return state


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root")), F.sum(F.hash("node", "root").cast("bigint"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min("root").alias("least")).select("node", F.least("node", "least").alias("least"))
    return both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    others = links.join(least, "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return others.unionByName(least.select("node", F.col("least").alias("root"))).distinct()
