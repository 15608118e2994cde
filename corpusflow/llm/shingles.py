"""Near copies of texts: sets of word shingles at a Jaccard similarity of ``SIMILARITY`` or more.

``BANDS`` keys of ``BAND_ROWS`` minimum hashes each are drawn from the shingles of every distinct text; two texts at the
threshold share a key with a chance of 0.9999, closer ones nearly always.  The smallest text of a key is its leader,
and all others of the key with a similar number of shingles are compared with it, shingle by shingle.  What is near a leader
leaves the key with it; the rest takes its next leaders in the next round, eight times as many, until no key has two texts left.
So of two texts that share a key and are near each other one is dropped.  Near copies cost one comparison a key however many
they are; a family of mutually different texts takes rounds by the logarithm of its number up to ``MOST_LEADERS`` leaders.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import staged_at
from corpusflow.storage import drop_table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 24, 5
#: Leaders of a key in a round: so many times those of the round before, and the most; their number bounds what a round writes.
MORE_LEADERS, MOST_LEADERS = 8, 512
SEED = 42
#: Shingles that are hashed together, so that a text of any length takes bounded memory.
SHINGLES_AT_ONCE = 1 << 14

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FACTORS = np.array([xxhash.xxh64_intdigest(f"factor {i}", SEED) | 1 for i in range(BANDS * BAND_ROWS)], np.uint64)
_TERMS = np.array([xxhash.xxh64_intdigest(f"term {i}", SEED) for i in range(BANDS * BAND_ROWS)], np.uint64)


def shingle_set(data: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; one of all words where they are fewer than a shingle."""
    words = data.translate(_LOWER).split()
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    if n == 1:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key a band: a hash of its minimum hashes."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        part = shingles[at : at + SHINGLES_AT_ONCE]
        for i, (factor, term) in enumerate(zip(_FACTORS, _TERMS, strict=True)):
            least[i] = min(least[i], (part * factor + term).min())
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)], np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _bytes(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(_bytes(text)) for text in batch.column(1)]
        if sets:
            keys = np.concatenate([band_keys(shingles) for shingles in sets]).view(np.int64)
            nodes, sizes = np.repeat(batch.column(0).to_numpy(), BANDS), np.repeat([len(shingles) for shingles in sets], BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(keys), pa.array(sizes)], ["node", "key", "size"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, text in zip(batch.column(0), batch.column(1), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array([node.as_py()]), pa.array([shingle_set(_bytes(text)).tobytes()])], ["node", "shingles"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets are similar enough."""
    for batch in batches:
        sets = [[np.frombuffer(_bytes(value), np.uint64) for value in batch.column(i)] for i in (2, 3)]
        near = pa.array([similarity(a, b) >= SIMILARITY for a, b in zip(*sets, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["node", "leader"]).filter(near)


def near_links(texts: DataFrame) -> tuple[DataFrame, str]:
    """``node, leader`` of ``texts`` (``node, rank, text``; one row each) that are near each other, and the table's path.

    Leaders are those of the smallest ``rank``, a BIGINT, of equal ones of the smallest ``node``; a null rank is last.
    Null texts are like empty ones, which all have the same set.
    """
    spark = texts.sparkSession
    keys, keys_path = staged_at(texts.select("node", "text").mapInArrow(_key_rows, "node BIGINT, key BIGINT, size BIGINT"), "band-keys")
    busy = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    busy, busy_path = staged_at(busy, "busy-keys")
    place = F.struct(F.col("rank").isNull().alias("void"), "rank", "node")
    open_rows = keys.join(busy, "key").join(texts.select("node", place.alias("place")), "node").select("key", "node", "place", "size")
    open_rows, path = staged_at(open_rows, "open-keys")
    some = open_rows.select("node").distinct()
    sets, sets_path = staged_at(texts.select("node", "text").join(some, "node", "left_semi").mapInArrow(_set_rows, "node BIGINT, shingles BINARY"), "shingle-sets")
    found, paths, width = None, [keys_path, busy_path, sets_path], 1
    while True:
        # the smallest text of each of so many parts of a key leads it
        part = F.pmod(F.xxhash64("node"), F.lit(width))
        leaders = open_rows.groupBy("key", part.alias("part")).agg(F.min(F.struct("place", "size")).alias("first"))
        leaders = leaders.select("key", F.col("first.place.node").alias("leader"), F.col("first.size").alias("leader_size"))
        leaders, leaders_path = staged_at(leaders, "leaders")
        # sets of too different sizes cannot be similar enough
        fit = F.least("size", "leader_size") + 1e-6 >= SIMILARITY * F.greatest("size", "leader_size")
        met = open_rows.join(leaders, "key").where((F.col("node") != F.col("leader")) & fit)
        met, met_path = staged_at(met.select("key", "node", F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")), "met")
        pairs = met.select("a", "b").distinct()
        pairs = pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "own"}), "a")
        pairs = pairs.join(sets.withColumnsRenamed({"node": "b", "shingles": "other"}), "b").select("a", "b", "own", "other")
        near, near_path = staged_at(pairs.mapInArrow(_near, "node BIGINT, leader BIGINT"), "near")
        found = near if found is None else found.unionByName(near)
        done = met.join(near.toDF("a", "b"), ["a", "b"]).select("key", "node")
        done = done.unionByName(leaders.select("key", F.col("leader").alias("node")))
        rest, rest_path = staged_at(open_rows.join(done, ["key", "node"], "left_anti"), "open-keys")
        paths.append(near_path)
        for old in (met_path, leaders_path, path):
            drop_table(spark, old)
        open_rows, path = rest.select("key", "node", "place", "size"), rest_path
        if open_rows.isEmpty():
            break
        width = min(MOST_LEADERS, MORE_LEADERS * width)
    found = spark.createDataFrame([], "node BIGINT, leader BIGINT") if found is None else found
    links, links_path = staged_at(found, "near-links")
    for old in [*paths, path]:
        drop_table(spark, old)
    return links, links_path
