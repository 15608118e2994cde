"""Learning byte-pair merges as a loop of distributed aggregations over an index of pairs.

State is one row per distinct chunk: a *symbol string* (one character per token id) and the chunk's
frequency.  A merge is then the SQL function ``replace`` - left to right, without overlap - and pair
counts are an ``explode`` with a grouped sum, so the whole loop stays in the JVM.

States are written out every few dozen merges (the *base*) and cached.  A token made since the base came from two tokens side by
side, so chunks that hold it are among those whose base string has that pair; what such a chunk looks like by now is its base
string with the merges since then replayed.  A round finds the chunks with the pairs it merges, replays those alone, and
counts what they lost and won.  The first tokens are in so many chunks that these are found by looking through
all strings; later bases have an inverted index, for each pair that is next to be merged the chunks that hold it, sorted by pair
within the partitions and cached, so that a lookup reads little more than the rows it wants.  The index is never updated.

The driver keeps the counts of the ``CANDIDATES`` most frequent pairs of a base and adds every round's differences to them.  A pair
that is not among them never had more than the *floor*, the count of the last candidate, and counts only ever
fall after a pair has come up; so ranking is exact while there are pairs before the floor, and else a new base is made.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.pretokenize import (
    SPLIT_PATTERN,
    adjacent_pairs,
    byte_symbols,
    pretokenize,
    symbol,
    token_of,
)
from corpusflow.operators.vocabulary import Merge, Vocabulary
from corpusflow.sources.config import SPECIAL_TOKENS
from corpusflow.storage import drop_table, write_table

#: Pairs whose counts the driver keeps.
CANDIDATES = 8192
#: Merges replayed on top of a base before it is written anew; late merges change few chunks, so the
#: limit grows with the vocabulary, up to the second number.
MERGES_PER_BASE = (48, 384)
#: Bases with so many merges behind them have an index, of so many of their best pairs.
INDEX_FROM, INDEXED_PAIRS = 768, 1024
#: Parts the rules of a replay; no token id has this character.
SEPARATOR = chr(0x10FFFF)


def chunk_freq(df: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each distinct chunk occurs; combined on the map side, so hot chunks do no harm."""
    return (
        df.select(F.explode(pretokenize(text_col)).alias("chunk"))
        .groupBy("chunk")
        .agg(F.count("*").alias("freq"))
    )


def chunk_states(freq: DataFrame) -> DataFrame:
    """Symbol strings of all chunks that have at least one pair."""
    return freq.select(byte_symbols("chunk").alias("symbols"), "freq").where(F.char_length("symbols") > 1)


def exploded_pairs(states: DataFrame) -> DataFrame:
    return states.select(F.explode(adjacent_pairs(F.col("symbols"))).alias("pair"), F.col("freq").alias("pair_freq"))


def count_pairs(states: DataFrame) -> DataFrame:
    """Adjacent pairs weighted by chunk frequency."""
    return exploded_pairs(states).groupBy("pair").agg(F.sum("pair_freq").alias("pair_freq"))


def pair_table(freq: DataFrame) -> DataFrame:
    """Pair counts before any merge, as ids: ``(left_id, right_id, pair_freq)``."""
    return count_pairs(chunk_states(freq)).select(
        F.ascii(F.substring("pair", 1, 1)).alias("left_id"),
        F.ascii(F.substring("pair", 2, 1)).alias("right_id"),
        "pair_freq",
    )


def apply_merges(symbols: Column, merges: list[tuple[int, Merge]]) -> Column:
    """Rewrite a symbol string by the given ``(new id, merge)`` list, in order."""
    if not merges:
        return symbols
    # one literal, however many rules there are
    rules = F.split(F.lit(SEPARATOR.join(symbol(m.left_id) + symbol(m.right_id) + symbol(made) for made, m in merges)), SEPARATOR)
    return F.aggregate(
        rules,
        symbols,
        lambda text, rule: F.replace(text, F.substring(rule, 1, 2), F.substring(rule, 3, 1)),
    )


def independent_prefix(ranked: list[tuple[int, int, int]], room: int) -> list[Merge]:
    """The longest head of the ranking that may be merged at once with the result of one at a time.

    A pair joins while it cannot share a token with a pair taken before it: its left side is no taken
    right side and its right side no taken left side.  Counts of such pairs do not change each other,
    and a pair holding a new id cannot outrank them.  A pair of equal ids breaks that bound, so it ends
    the batch.  The first pair that does not fit ends it as well.
    """
    taken: list[Merge] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    for left, right, freq in ranked:
        if len(taken) >= room or left in rights or right in lefts:
            break
        taken.append(Merge(left, right, freq))
        if left == right:
            break
        lefts.add(left)
        rights.add(right)
    return taken


@dataclass
class TrainingRun:
    """A learned vocabulary and how it came about."""

    vocab: Vocabulary
    rounds: int
    seconds: float

    def report(self, spark: SparkSession) -> DataFrame:
        specials = list(self.vocab.special_names[role] for role in self.vocab.specials)
        return spark.createDataFrame(
            [(self.vocab.n_vocab, len(self.vocab.merges), self.rounds, specials, SPLIT_PATTERN, self.seconds)],
            "vocab_size INT, merges INT, rounds INT, special_tokens ARRAY<STRING>, split_pattern STRING, "
            "train_seconds DOUBLE",
        )


class _Base:
    """Chunk states as written last, the index of their pairs, and the merges made on top of them."""

    def __init__(self, states: DataFrame, made: int) -> None:
        self.spark = states.sparkSession
        cores = self.spark.sparkContext.defaultParallelism
        # rewriting strings costs far more than reading them, so spread the rows over all cores
        self.states, self.path = write_table(states.repartition(cores, "symbols"), "bpe-states")
        self.states = self.states.persist(StorageLevel.MEMORY_AND_DISK)
        rows = count_pairs(self.states).orderBy(F.desc("pair_freq"), "pair").limit(CANDIDATES + 1).collect()
        self.counts = {row.pair: row.pair_freq for row in rows[:CANDIDATES]}
        self.floor = self._place(*rows[CANDIDATES - 1]) if len(rows) > CANDIDATES else None
        self.first, self.merges = 256 + made, []
        self.indexed = {row.pair for row in rows[:INDEXED_PAIRS]} if made >= INDEX_FROM else set()
        self.index = self._index() if self.indexed else None

    def _index(self) -> DataFrame:
        """``pair, symbols, freq`` of the pairs that are next to be merged and the chunks that hold them."""
        wanted = self.spark.createDataFrame([(pair,) for pair in self.indexed], "pair STRING")
        held = self.states.select(F.explode(F.array_distinct(adjacent_pairs(F.col("symbols")))).alias("pair"), "symbols", "freq")
        # every partition has the index of its own chunks, so a pair of very many chunks is looked up by all of them
        found = held.join(F.broadcast(wanted), "pair", "left_semi")  # INDEXED_PAIRS short rows
        return found.sortWithinPartitions("pair").persist(StorageLevel.MEMORY_AND_DISK)

    @staticmethod
    def _place(pair: str, freq: int) -> tuple[int, int, int]:
        """Pairs in the order of this are ranked."""
        return -freq, token_of(pair[0]), token_of(pair[1])

    def worn(self) -> bool:
        return len(self.merges) >= min(MERGES_PER_BASE[0] + self.first // 8, MERGES_PER_BASE[1])

    def ranking(self) -> list[tuple[int, int, int]]:
        """The pairs down to the floor, by count, then left id, then right id."""
        places = sorted(self._place(pair, freq) for pair, freq in self.counts.items())
        return [(left, right, -count) for count, left, right in places]

    def _key(self, left: int, right: int) -> str:
        """A pair of the base that every chunk with the given pair has in its base string."""
        while max(left, right) >= self.first:
            merge = self.merges[(left if left >= self.first else right) - self.first]
            left, right = merge.left_id, merge.right_id
        return symbol(left) + symbol(right)

    def _numbered(self, merges: list[Merge], first: int) -> list[tuple[int, Merge]]:
        return list(enumerate(merges, first))

    def holders(self, batch: list[Merge]) -> DataFrame:
        """``symbols, freq`` of the chunks that may hold a pair of the batch, each once, as they were in the base."""
        keys = list(dict.fromkeys(self._key(m.left_id, m.right_id) for m in batch))
        if self.indexed.issuperset(keys):  # a chunk with several of them counts for the first
            held = F.filter(F.split(F.lit(SEPARATOR.join(keys)), SEPARATOR), lambda key: F.contains("symbols", key))
            found = self.index.where(F.col("pair").isin(keys) & (F.col("pair") == held[0]))
        else:
            found = self.states.where(reduce(Column.__or__, [F.contains("symbols", F.lit(key)) for key in keys]))
        return found.select("symbols", "freq")

    def changes(self, batch: list[Merge]) -> DataFrame:
        """``pair, pair_freq``: by how much the merges of the batch change the counts of pairs."""
        since = self._numbered(self.merges, self.first)
        made = self._numbered(batch, self.first + len(self.merges))
        before = self.holders(batch).select(apply_merges(F.col("symbols"), since).alias("before"), "freq")
        both = before.withColumn("after", apply_merges(F.col("before"), made)).where("before <> after")
        signed = F.array(F.struct(F.col("before").alias("symbols"), (-F.col("freq")).alias("freq")), F.struct(F.col("after").alias("symbols"), "freq"))
        changes = exploded_pairs(both.select(F.inline(signed))).groupBy("pair").agg(F.sum("pair_freq").alias("pair_freq")).where("pair_freq <> 0")
        if self.floor is None:
            return changes
        # of the others, those of the new tokens alone can be above the floor
        new = [symbol(token) for token, _ in made]
        risen = (F.substring("pair", 1, 1).isin(new) | F.substring("pair", 2, 1).isin(new)) & (F.col("pair_freq") >= -self.floor[0])
        known = self.spark.createDataFrame(pa.table({"pair": list(self.counts), "known": [True] * len(self.counts)}))
        # CANDIDATES short rows, and the new ones since
        return changes.join(F.broadcast(known), "pair", "left").where(F.col("known") | risen).select("pair", "pair_freq")

    def merge(self, batch: list[Merge]) -> None:
        changed = self.changes(batch).toArrow()
        self.merges += batch
        for pair, change in zip(changed["pair"].to_pylist(), changed["pair_freq"].to_pylist(), strict=True):
            count = self.counts.get(pair, 0) + change
            if count > 0 and (self.floor is None or self._place(pair, count) <= self.floor):
                self.counts[pair] = count
            else:
                self.counts.pop(pair, None)
        if len(self.counts) > 2 * CANDIDATES:
            kept = sorted(self.counts, key=lambda pair: self._place(pair, self.counts[pair]))[:CANDIDATES]
            self.floor = self._place(kept[-1], self.counts[kept[-1]])
            self.counts = {pair: self.counts[pair] for pair in kept}

    def rewritten(self) -> DataFrame:
        """All states with the merges since the base."""
        merged = apply_merges(F.col("symbols"), self._numbered(self.merges, self.first)).alias("symbols")
        return self.states.select(merged, "freq").where(F.char_length("symbols") > 1)

    def renewed(self) -> "_Base":
        new = _Base(self.rewritten(), self.first - 256 + len(self.merges))
        self.drop()
        return new

    def drop(self) -> None:
        self.states.unpersist()
        if self.index is not None:
            self.index.unpersist()
        drop_table(self.spark, self.path)


def learn_merges(freq: DataFrame, vocab_size: int, special_names: dict[str, str] | None = None) -> TrainingRun:
    """Learn merges until ``vocab_size - 4`` ids are in use or no pair is left.

    Pairs are ranked by count, then by smaller left id, then by smaller right id.
    """
    room = vocab_size - len(SPECIAL_TOKENS)
    if room < 256:
        raise ValueError(f"vocab_size must be at least {256 + len(SPECIAL_TOKENS)}, got {vocab_size}")
    began = time.perf_counter()
    merges: list[Merge] = []
    rounds = 0
    base = _Base(chunk_states(freq), 0) if room > 256 else None
    while 256 + len(merges) < room:
        if base.worn():
            base = base.renewed()
        batch = independent_prefix(base.ranking(), room - 256 - len(merges))
        if batch:
            base.merge(batch)
            merges += batch
            rounds += 1
        elif base.floor and base.merges:  # what is left lies beyond the floor of this base
            base = base.renewed()
        else:
            break
    if base is not None:
        base.drop()
    vocab = Vocabulary(merges, dict(special_names or SPECIAL_TOKENS))
    return TrainingRun(vocab, rounds, time.perf_counter() - began)
