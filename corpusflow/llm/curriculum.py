"""Mixing sources to target weights over the time of a training run.

Every source has a schedule: its weight at each time from 0 to 1, straight between knots.  The integral of a schedule is the
source's share of all tokens that the run takes; a share above ``MOST_PASSES`` times what the source has is cut there and what is over
goes to the others.  The demand for a source's tokens up to a time is the integral of its schedule up to there, so a token's place in its
source, turned back through that curve, is the time at which it is trained on.  Documents are sorted by that time over ranges.

Documents of a source follow a seeded order, again from the start when all are used up.  Where the demand ends inside a
document, that document is cut, so a source gives its share to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import null_safe_join, pick, staged_at
from corpusflow.llm.placing import placed
from corpusflow.storage import drop_table

Schedule = tuple[tuple[float, float], ...]
#: Knots (time, weight) of the schedules, dealt to the sources in turn; their integrals are 5, 2 and 1.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 7.5), (1.0, 2.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)))
#: Tokens of the run as a share of all there are, and how often a document is used at most.
BUDGET, MOST_PASSES, SEED = 1.5, 2, 42


def segments(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """``start, end, weight there, weight at the end, integral before`` of the stretches between knots."""
    found, before = [], 0.0
    for (start, low), (end, high) in zip(schedule[:-1], schedule[1:], strict=True):
        if end < start or low < 0 or high < 0:
            raise ValueError(f"knots must go forward and weights must not be negative: {schedule}")
        if end > start:
            found.append((start, end, low, high, before))
            before += (low + high) / 2 * (end - start)
    if len(schedule) < 2 or (schedule[0][0], schedule[-1][0]) != (0, 1) or before <= 0:
        raise ValueError(f"a schedule goes from 0 to 1 with some weight between: {schedule}")
    return found


def integral(schedule: Schedule) -> float:
    start, end, low, high, before = segments(schedule)[-1]
    return before + (low + high) / 2 * (end - start)


def time_of(share: Column, number: Column, schedules: tuple[Schedule, ...] = SCHEDULES) -> Column:
    """When a schedule has used up ``share``, from 0 to 1, of its integral; ``number`` tells which one."""
    names = ["start", "end", "low", "high", "before"]
    tables = [F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, part, strict=True)]) for part in segments(s)]) for s in schedules]
    whole = F.element_at(F.array(*[F.lit(integral(s)) for s in schedules]), number + 1) * share
    part = F.try_element_at(F.filter(F.element_at(F.array(*tables), number + 1), lambda p: p["before"] <= whole), F.lit(-1))
    # the weight goes from low to high, so its integral is a parabola; this form of its root is safe for level and falling weights
    inside = whole - part["before"]
    bent = part["low"] * part["low"] + 2 * ((part["high"] - part["low"]) / (part["end"] - part["start"])) * inside
    slope = part["low"] + F.sqrt(F.greatest(bent, F.lit(0.0)))
    return F.least(part["start"] + F.when(slope > 0, 2 * inside / slope).otherwise(0.0), part["end"])


def source_targets(sources: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, budget: float = BUDGET) -> DataFrame:
    """``sources`` (``source_size, schedule``) with ``target``: the share of each, none above ``MOST_PASSES`` times its size.

    What a source cannot take goes to the others by weight until no share is above; every round is one aggregate.
    """
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    rows = sources.withColumn("weight", F.element_at(weights, F.col("schedule") + 1))
    limit = F.col("source_size") * MOST_PASSES
    full, share, n_full = F.lit(False), F.lit(0.0), -1
    while True:
        free_weight, used, whole, now = rows.agg(
            F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, limit)), F.sum("source_size"), F.count_if(full)
        ).first()
        # full sources stay full, as the others' shares only grow
        if now == n_full or not free_weight:
            return rows.withColumn("target", F.when(full, limit.cast("double")).otherwise(share)).drop("weight")
        share = F.lit(budget * whole - (used or 0)) * F.col("weight") / F.lit(free_weight)
        full, n_full = share > limit, now


def mix(documents: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, budget: float = BUDGET) -> DataFrame:
    """The documents of a training run in its order, once for each time they are used.

    ``row, doc_id, source, size, source_size, target, pass, start, words, position``: ``words`` of the document are trained on at
    ``position``, in the ``pass``-th use of the source, from 0; ``start`` is the place in all of the source's uses.  ``row`` tells rows of
    ``documents`` apart.  A row that is not used at all comes once, at the end, with 0 words and null pass, start and position.

    ``size`` is the number of words, 0 of a null text.  Sources take the schedules in turn, by code point, null last, and null
    is a source like others.  Rows of one id and size are alike, so it does not matter which of them comes first.  The order depends on
    ids and sizes alone.  No documents give no rows.
    """
    spark = documents.sparkSession
    rows = pick(documents, "doc_id", "source", "text").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size")
    )
    rows, rows_path = staged_at(rows.withColumn("turn", F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))), "mix-sizes")
    order = [F.col("source").asc_nulls_last(), F.col("turn"), F.col("doc_id"), F.col("size")]
    ordered, ordered_path = placed(rows, order, ("size",), "mix-order")
    sums = ordered.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("size_before").alias("first"))
    sources, sources_path = placed(sums, [F.col("source").asc_nulls_last()], label="mix-sources")
    sources = sources.withColumn("schedule", (F.col("place") % len(schedules)).cast("int")).drop("place")
    targets = source_targets(sources, schedules, budget)
    drop_table(spark, rows_path)
    # one short row a source: Spark broadcasts it if it is small
    joined = null_safe_join(ordered, targets, ["source"], "inner")
    joined = joined.withColumns({"row": F.col("place"), "offset": F.col("size_before") - F.col("first"), "demand": F.floor("target")})
    passes = F.sequence(F.lit(0), F.lit(MOST_PASSES - 1))
    uses = F.transform(passes, lambda p: F.struct(p.alias("pass"), (p * F.col("source_size") + F.col("offset")).alias("start")))
    uses = F.transform(uses, lambda u: F.struct(u["pass"].alias("pass"), u["start"].alias("start"), F.least("size", F.col("demand") - u["start"]).alias("words")))
    used = joined.select("*", F.inline_outer(F.filter(uses, lambda u: u["words"] > 0)))
    middle = (F.col("start") + F.col("words") / 2) / F.col("target")
    used = used.withColumns({"position": time_of(middle, F.col("schedule"), schedules), "words": F.coalesce("words", F.lit(0).cast("bigint"))})
    used = used.select("row", "doc_id", "source", "size", "source_size", "target", "pass", "start", "words", "position")
    by_time = [F.col("position").asc_nulls_last(), F.col("row"), F.col("pass")]
    return used.repartitionByRange(*by_time).sortWithinPartitions(*by_time)


def taken_words(documents: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_position`` of every document: what :func:`mix` makes of it."""
    of_row = mix(documents).groupBy("row", "doc_id", "size", "source_size", "target")
    return of_row.agg(F.sum("words").alias("taken"), F.min("position").alias("first_position")).drop("row")
