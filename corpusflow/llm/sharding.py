"""Sharding by histogram sort.

Shards are ranges of the key, cut so that each holds the same number of bytes.  The cuts are found
without sorting anything: in every round each task counts the exact bytes and rows below a set of
candidate keys (one binary search per row), the counts are added up, and for each cut the interval
that holds it is probed again more finely.  A key that repeats so often that a cut falls inside it is cut
by the place of its rows.  When all cuts are known every row knows its shard, and the texts are
exchanged once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import pick, rest, staged

#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: Candidate keys between the two ends of the interval of one cut, per round.
PROBES = 32
#: Ranges that a shard is exchanged in, so that one shard is not one task.
BLOCKS_PER_SHARD = 4
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def _histogram(rows: DataFrame, within: list[int | None], probes: list[np.ndarray]) -> dict[int, tuple[int, int]]:
    """Exact ``(bytes, rows)`` between neighbouring probes.

    ``probes[i]`` are sorted keys, or sorted places inside the key ``within[i]``.  Slots of list ``i`` start
    at the sum of the sizes, plus one each, of the lists before it.  Every task adds up its own counts, so
    what is shuffled and collected is bounded by the number of probes.
    """
    starts = np.cumsum([0] + [len(p) + 1 for p in probes])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, number = np.zeros(starts[-1], np.int64), np.zeros(starts[-1], np.int64)
        for batch in batches:
            key, place, weight = (batch.column(i).to_numpy() for i in range(3))
            for i, (inside, wanted) in enumerate(zip(within, probes, strict=True)):
                mine = slice(None) if inside is None else key == inside
                value = (key if inside is None else place)[mine]
                slot = np.searchsorted(wanted, value, side="right")
                here = slice(starts[i], starts[i + 1])
                size[here] += np.bincount(slot, weight[mine], len(wanted) + 1).astype(np.int64)
                number[here] += np.bincount(slot, minlength=len(wanted) + 1)
        some = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(size[some]), pa.array(number[some])], ["slot", "size", "number"])

    partial = rows.mapInArrow(count, "slot BIGINT, size BIGINT, number BIGINT")
    total = partial.groupBy("slot").agg(F.sum("size").alias("size"), F.sum("number").alias("number"))
    return {row["slot"]: (row["size"], row["number"]) for row in total.collect()}


class _Cut:
    """The largest value below which there are fewer than ``target`` bytes, closed in on from both sides."""

    def __init__(self, target: int, low: int, high: int, size: int, number: int):
        self.target = target
        self.low, self.below = low, (0, 0)
        self.high, self.through = high, (size, number)

    def candidates(self, count: int) -> list[int]:
        gap = self.high - self.low
        return sorted({self.low + gap * i // (count + 1) for i in range(1, count + 1)} - {self.low})

    def learn(self, value: int, below: tuple[int, int]) -> None:
        if below[0] < self.target:
            if value >= self.low:
                self.low, self.below = value, below
        elif value <= self.high:
            self.high, self.through = value, below

    def settled(self, tolerance: int) -> bool:
        return self.high - self.low <= 1 or self.through[0] - self.target <= tolerance

    @property
    def last(self) -> tuple[int, int, tuple[int, int]]:
        """Last value before the cut, rows of it, and the counts up to it."""
        return self.high - 1, self.through[1] - self.below[1] if self.high - self.low <= 1 else 1, self.through


def _close_in(rows: DataFrame, groups: dict[int | None, list[_Cut]], tolerance: int, probes: int) -> None:
    """Probe until every cut is settled; the cuts of one group share their probes."""
    while open_groups := [key for key, cuts in groups.items() if not all(cut.settled(tolerance) for cut in cuts)]:
        wanted = [
            np.array(sorted({v for cut in groups[key] if not cut.settled(tolerance) for v in cut.candidates(probes)}), np.int64)
            for key in open_groups
        ]
        counts, slot = _histogram(rows, open_groups, wanted), 0
        for key, values in zip(open_groups, wanted, strict=True):
            size = number = 0
            for value in values.tolist():
                more = counts.get(slot, (0, 0))
                size, number, slot = size + more[0], number + more[1], slot + 1
                for cut in groups[key]:
                    cut.learn(value, (size, number))
            slot += 1


def find_cuts(rows: DataFrame, n: int, tolerance: int = 0, probes: int = PROBES) -> list[tuple[int, int, int]]:
    """The ``n - 1`` cuts of ``rows`` (``key, place, size``, all BIGINT) into ``n`` parts of equal bytes.

    A cut is ``(key, place, rows before it)``: what is not greater than ``(key, place)`` lies before it.  With a
    tolerance of 0 the first row after cut ``i`` is the first that has ``i / n`` of all bytes before it.
    """
    whole = rows.agg(F.min("key"), F.max("key"), F.min("place"), F.max("place"), F.sum("size"), F.count("*")).first()
    low, high, first, last, size, number = whole
    if not number:
        return []
    targets = [-(-i * size // n) for i in range(1, n)]
    cuts = [_Cut(target, low, high + 1, size, number) for target in targets]
    _close_in(rows, {None: cuts}, tolerance, probes)
    inner: dict[int, list[_Cut]] = {}
    found: list[tuple[int, int, int] | _Cut] = []
    for cut in cuts:
        key, many, (through, before) = cut.last
        if many > 1 and through - cut.target > tolerance:
            # the cut falls inside a repeated key: go on by the place of its rows
            inside = _Cut(cut.target - cut.below[0], first, last + 1, through - cut.below[0], before - cut.below[1])
            inner.setdefault(key, []).append(inside)
            found.append((key, cut.below[1], inside))
        else:
            found.append((key, HIGHEST, before))
    if inner:
        _close_in(rows.where(F.col("key").isin(list(inner))), inner, tolerance, probes)
    return [(c[0], c[2].last[0], c[1] + c[2].last[2][1]) if isinstance(c[2], _Cut) else c for c in found]


def histogram_sort(
    documents: DataFrame,
    n_shards: int,
    key: str = "doc_id",
    text: str = "text",
    tolerance: int = 0,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
) -> DataFrame:
    """Documents with ``size``, ``shard`` (0 to ``n_shards - 1``) and ``slot`` (0, 1, ... inside a shard).

    Shards are ranges of ``key`` (any integer column) and differ in bytes by about one document, plus
    ``tolerance``.  Inside a shard rows are slotted by key.  A null key comes first; a null text has no bytes;
    rows with equal keys, even wholly equal rows, keep the order in which they were read and may be
    cut apart.  Few rows leave shards empty; no rows give no rows.  Input columns that are named like
    a result column are left out.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    kept = rest(documents, "size", "shard", "slot", need=(key, text))
    carried = [f"c{i}" for i in range(len(kept))]
    rows = staged(
        pick(documents, *kept)
        .toDF(*carried)
        .withColumn("size", F.coalesce(F.octet_length(carried[kept.index(text)]), F.lit(0)).cast("bigint") + ROW_BYTES)
        .withColumn("key", F.coalesce(F.col(carried[kept.index(key)]).cast("bigint"), F.lit(LOWEST)))
        # a number that the written table fixes, so that a task run again deals its rows out alike
        .withColumn("place", F.monotonically_increasing_id()),
        "shard-input",
    )
    cuts = find_cuts(rows.select("key", "place", "size"), n_shards * blocks_per_shard, tolerance)
    keys, places = (np.array([cut[i] for cut in cuts], np.int64) for i in range(2))
    before = np.array([0] + [cut[2] for cut in cuts], np.int64)
    first_of_shard = before[:: blocks_per_shard] if len(cuts) else before
    repeated = [int(k) for k in np.unique(keys)]

    @F.pandas_udf("struct<block: int, shard: int, base: bigint>")
    def place_row(key: pd.Series, place: pd.Series) -> pd.DataFrame:
        key, place = key.to_numpy(), place.to_numpy()
        block = np.searchsorted(keys, key, side="left")
        for k in repeated:
            at = np.flatnonzero(key == k)
            if len(at):
                low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
                block[at] = low + np.searchsorted(places[low:high], place[at], side="left")
        shard = block // blocks_per_shard
        return pd.DataFrame({"block": block.astype(np.int32), "shard": shard.astype(np.int32), "base": before[block] - first_of_shard[shard]})

    placed = rows.withColumn("at", place_row("key", "place"))
    inside = Window.partitionBy("at.block").orderBy("key", "place")
    slotted = placed.withColumn("slot", F.col("at.base") + F.row_number().over(inside) - 1)
    return slotted.select(
        *[F.col(c).alias(name) for c, name in zip(carried, kept, strict=True)], "size", F.col("at.shard").alias("shard"), "slot"
    )
