"""Near-duplicates by SimHash, searched with vantage-point trees.

Every text becomes a 64-bit fingerprint; fingerprints link at ``RADIUS`` or fewer differing bits.  Equal
fingerprints are one node, whatever their number, so what is searched has no copies.

Over 64 bits nearly all fingerprints lie at distance 32 of any vantage point, and a triangle bound prunes
little.  So there are two trees, each over one half of the bits: of two differing bits at most one
lies in one of the halves, so in that half's tree a radius of one finds the pair.  Every level of a tree parts
the fingerprints by their Hamming distance to its vantage point; the distances along the path name the
shard.  By the triangle inequality a partner at distance one is one off at every level; of the shards that
border on a query's shard in this way only those are visited that a point within the radius can be in, at
most 32.  A point at odd distance lies in a shard of the other parity, so only the points with an even
number of bits go visiting, and each pair is met once.  Shards are exchanged by their path, and
the pairs met there are compared over all 64 bits.

A fingerprint has at most 2,080 others within two bits, so links grow with the input however a group of
near copies is made up.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import null_safe_join, one_of_each, pick, small_batches, staged, without_documents
from corpusflow.llm.components import components
from corpusflow.llm.shingles import near_links as near_copy_links

WORDS_PER_SHINGLE = 3
SEED = 42
RADIUS = 2
#: Vantage points on a path of each tree.  More make smaller shards; ten fit into a 64-bit path.
LEVELS = 10
HALF_BITS = 32
HALF_MASK = np.uint64((1 << HALF_BITS) - 1)
#: Shingles whose bits are counted together, so that a text of any length takes bounded memory.
SHINGLES_AT_ONCE = 1 << 16

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None) -> int:
    """SimHash of a text as an unsigned number; 0 without words."""
    # bytes.split() cuts at \x20 and \x09-\x0D
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < WORDS_PER_SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - WORDS_PER_SHINGLE + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = words[at : at + SHINGLES_AT_ONCE + WORDS_PER_SHINGLE - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(WORDS_PER_SHINGLE)), strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def simhash(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(text.as_py()) for text in texts], np.uint64).view(np.int64))


def vantage_points(tree: int, levels: int = LEVELS) -> np.ndarray:
    """Fixed pseudo-random points of one tree."""
    return np.array([xxhash.xxh64_intdigest(f"{tree}:{level}", SEED) for level in range(levels)], np.uint64) & HALF_MASK


def shard_path(half: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances to the vantage points, six bits each."""
    path = np.zeros(len(half), np.int64)
    for level, point in enumerate(points):
        path |= np.bitwise_count(half ^ point).astype(np.int64) << (6 * level)
    return path


def bordering_paths(half: np.ndarray, path: np.ndarray, points: np.ndarray) -> Iterator[np.ndarray]:
    """Paths of all points at distance one: at every level one nearer or one farther."""
    for bit in range(HALF_BITS):
        step = np.zeros(len(half), np.int64)
        for level, point in enumerate(points):
            apart = ((half ^ point) >> np.uint64(bit) & np.uint64(1)).astype(np.int64)
            step += (1 - 2 * apart) << (6 * level)
        yield path + step


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(tree, path, fingerprint, visit)``: where each fingerprint lives, and the shards it visits."""
    for batch in batches:
        values = batch.column(0).to_numpy()
        for tree in range(2):
            half = (values.view(np.uint64) >> np.uint64(HALF_BITS * tree)) & HALF_MASK
            points = vantage_points(tree)
            home = shard_path(half, points)
            yield _rows(tree, home, values, False)
            even = np.bitwise_count(half) % 2 == 0
            paths = np.sort(np.stack(list(bordering_paths(half[even], home[even], points)), axis=1), axis=1)
            first = np.ones(paths.shape, bool)
            first[:, 1:] = paths[:, 1:] != paths[:, :-1]
            yield _rows(tree, paths[first], np.repeat(values[even], first.sum(axis=1)), True)


def _rows(tree: int, path: np.ndarray, values: np.ndarray, visit: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(path), tree, np.int32)), pa.array(path), pa.array(values), pa.array(np.full(len(path), visit))],
        ["tree", "path", "value", "visit"],
    )


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_links(fingerprints: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of distinct values of ``fingerprints`` (``fingerprint``, BIGINT) at most ``RADIUS`` bits apart.

    Each pair comes once or, if both trees find it, twice.
    """
    placed = fingerprints.select("fingerprint").mapInArrow(_shards, "tree INT, path BIGINT, value BIGINT, visit BOOLEAN")
    placed = staged(placed, "vantage-shards")
    home = placed.where("NOT visit").select("tree", "path", F.col("value").alias("b"))
    # inside its own shard a point looks at the larger ones, in a bordering shard at all
    looking = placed.select("tree", "path", F.col("value").alias("a"), "visit")
    near = (distance(F.col("a"), F.col("b")) <= RADIUS) & (F.col("visit") | (F.col("a") < F.col("b")))
    return looking.join(home, ["tree", "path"]).where(near).select("a", "b")


def _grouped(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables: rows as ``doc_id, text_key, fingerprint``, and ``fingerprint, root, component_id`` of each fingerprint."""
    rows = pick(documents, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), simhash("text").alias("fingerprint")
    )
    rows = staged(rows, "fingerprints")
    nodes = staged(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(near_links(nodes))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, staged(rooted.join(smallest, "root").select("fingerprint", "root", "component_id"), "groups")


def near_duplicate_groups(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (BIGINT) ``, component_id`` for each row of ``documents`` (``doc_id, text``).

    ``component_id`` is the smallest id that links of fingerprints reach, the row's own included.  Null and empty
    texts have fingerprint 0, which links like any other.  Rows with equal ids or texts stay rows of their
    own; a null id counts for no smallest id, and a group of null ids alone has none.  No rows give
    no rows.  Further columns are not looked at.
    """
    with small_batches(documents.sparkSession):
        rows, named = _grouped(documents)
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _fingerprint_links(texts: DataFrame) -> DataFrame:
    """Links ``a, b`` of ``texts`` (``node, text``): with the first text of the same fingerprint, and between those of near fingerprints."""
    prints = staged(texts.select("node", simhash("text").alias("fingerprint")), "text-fingerprints")
    firsts = staged(prints.groupBy("fingerprint").agg(F.min("node").alias("first")), "distinct-fingerprints")
    same = prints.join(firsts, "fingerprint").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    near = near_links(firsts).join(firsts.toDF("a", "first_a"), "a").join(firsts.toDF("b", "first_b"), "b")
    return same.unionByName(near.select(F.col("first_a").alias("a"), F.col("first_b").alias("b")))


def _near_copies(documents: DataFrame, fingerprints: bool) -> tuple[DataFrame, DataFrame]:
    """Written tables: rows as ``doc_id, text_key``, and ``text_key, root`` of each text, grouped by shingles and, if asked, fingerprints."""
    rows = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    texts = rows.groupBy("text_key").agg(F.min("doc_id").alias("rank"))
    texts = staged(texts, "distinct-texts")
    # one row of each text: that of its smallest id, and of equal rows the first
    firsts = null_safe_join(rows, texts.withColumn("doc_id", F.col("rank")), ["text_key", "doc_id"], "inner")
    firsts = staged(firsts.select(F.col("text_key").alias("node"), "rank", "text").dropDuplicates(["node"]), "first-copies")
    links = near_copy_links(firsts)[0].toDF("a", "b")
    roots = components(links.unionByName(_fingerprint_links(firsts)) if fingerprints else links)
    named = texts.join(roots, texts["text_key"] == roots["node"], "left").select("text_key", F.coalesce("root", "text_key").alias("root"))
    return staged(rows.select("doc_id", "text_key"), "rows"), staged(named, "groups")


def drop_near_duplicates(documents: DataFrame, fingerprints: bool = False) -> DataFrame:
    """One document of each group of near-duplicates, all columns and names as they are.

    Near-duplicates are texts whose sets of five-word shingles have a similarity of 0.8 or more, see ``shingles``.  With
    ``fingerprints`` those that :func:`near_duplicate_groups` puts into one group are too, and links of both kinds make one group.

    It is the one with the smallest id; null ids come last, and of equal ids the smallest ``xxhash64`` of the
    text decides.  Of rows with that id and that text one stays.  No rows give no rows.
    """
    with small_batches(documents.sparkSession):
        rows, named = _near_copies(documents, fingerprints)
    rank = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "text_key")
    members = rows.join(named, "text_key").groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n"))
    members = staged(members, "group-members")
    best = members.groupBy("root").agg(F.min(rank).alias("best"), F.count("*").alias("different"))
    judged = members.join(best, "root").withColumn("stays", rank == F.col("best"))
    gone = judged.where("NOT stays").select("doc_id", "text_key")
    repeated = staged(judged.where("stays AND n > 1").select("doc_id", "text_key"), "repeated-documents")
    if repeated.isEmpty():
        return without_documents(documents, gone)
    return without_documents(documents, gone.unionByName(repeated)).union(one_of_each(documents, repeated))
