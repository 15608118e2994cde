"""Throughput of training runs from a step log ``(run_id, step, ts, n_tokens)``.

A run may be very long, so no window spans a whole run.  Rows are cut into slices by step; a slice
does its own running work, and a table with one row per slice carries totals and last rows over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS_PER_SLICE = 1_000_000
SLICE = ("run_id", "slice")


def _running_total(log: DataFrame, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` from the start of the run up to and including the row."""
    up_to_here = Window.partitionBy(*SLICE).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("run_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        log.groupBy(*SLICE)
        .agg(F.sum(value).alias("in_slice"))
        .select(*SLICE, F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)).alias("carried"))
    )
    rows = log.withColumn(name, F.sum(value).over(up_to_here)).join(carried, list(SLICE))
    return rows.withColumn(name, F.col(name) + F.col("carried")).drop("carried")


def _previous(log: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``columns`` of the row before in the same run, as a struct."""
    row = F.struct(*columns)
    carried = (
        log.groupBy(*SLICE)
        .agg(F.max_by(row, "step").alias("last"))
        .select(*SLICE, F.lag("last").over(Window.partitionBy("run_id").orderBy("slice")).alias("carried"))
    )
    within = F.lag(row).over(Window.partitionBy(*SLICE).orderBy("step"))
    rows = log.withColumn(name, within).join(carried, list(SLICE))
    return rows.withColumn(name, F.coalesce(F.col(name), F.col("carried"))).drop("carried")


def throughput(
    log: DataFrame, every_n: int = 1, count: str = "all", steps_per_slice: int = STEPS_PER_SLICE
) -> DataFrame:
    """Tokens per second against the logged row before, and tokens so far.

    Steps with ``(step + 1) % every_n == 0`` are logged.  The first logged row of a run emits nothing;
    neither does a row whose clock did not advance, though the clock moves on.  ``count='all'`` counts
    the tokens of every step.  ``'sampled'`` counts only those of emitted rows, which under-counts as
    soon as ``every_n`` is above 1; it is there to reproduce dashboards made that way.
    """
    if every_n <= 0:
        raise ValueError("every_n must be positive")
    if count not in ("all", "sampled"):
        raise ValueError("count must be 'all' or 'sampled'")
    rows = log.select("run_id", "step", "ts", "n_tokens").withColumn("slice", F.expr(f"step div {steps_per_slice}"))
    if count == "all":
        rows = _running_total(rows, F.col("n_tokens"), "tokens_processed")
    else:
        rows = rows.withColumn("tokens_processed", F.lit(0).cast("bigint"))
    logged = rows.where((F.col("step") + 1) % every_n == 0)
    logged = _previous(logged, ["ts", "tokens_processed"], "before")
    elapsed = (F.unix_micros("ts") - F.unix_micros("before.ts")) / 1e6
    emitted = logged.withColumn("elapsed", elapsed).where("elapsed > 0")
    if count == "all":
        fresh = F.col("tokens_processed") - F.col("before.tokens_processed")
    else:
        fresh = F.col("n_tokens")
        emitted = _running_total(emitted, F.col("n_tokens"), "tokens_processed")
    return emitted.select("run_id", "step", "ts", (fresh / F.col("elapsed")).alias("tokens_per_sec"), "tokens_processed")
