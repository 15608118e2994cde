"""Near-duplicate embeddings by random-hyperplane sign hashing, exact cosine and connected components.

Equal vectors of one label are one node with a number of copies.  A node has a signature in each of several
tables: the signs of its products with random hyperplanes.  Nodes that share a signature in some table are
compared by their exact cosine.  A pair that meets in several tables is counted in the first one only,
which the signatures themselves tell, so counts of links add up without a list of pairs.

Nodes of a bucket are compared as blocks of at most ``BLOCK`` nodes: a larger bucket is dealt into chunks, and
every two chunks are a task's group of their own, so no task holds a whole bucket.  A block gives one
row per node: its links in it, and the smallest node that links inside the block reach.  From these rows
come the totals and, by connected components, the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import null_safe_join, pick, staged
from corpusflow.llm.components import components

COSINE = 0.93
#: Tables, and hyperplanes of each.  Two vectors at the threshold agree in the signs of one table with a chance of
#: 0.88 ** BITS, and in some table with one of 0.995; closer ones nearly always.
TABLES, BITS = 16, 10
#: Nodes of a chunk of a bucket.
BLOCK = 1024
SEED = 42


def _planes(dimension: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, TABLES * BITS))


def _unit(flat: np.ndarray, dimension: int) -> np.ndarray:
    vectors = flat.reshape(-1, dimension)
    # by the largest component first, so that no square overflows or vanishes
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _signatures_of(units: np.ndarray) -> np.ndarray:
    """One signature per row and table."""
    signs = (units @ _planes(units.shape[1]) > 0).reshape(len(units), TABLES, BITS)
    return signs @ (1 << np.arange(BITS))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, copies, label, dimension, vector`` with the components as bytes, from ``node, copies, label, embedding``."""
    for batch in batches:
        lists = batch.column(3)
        values = lists.flatten().to_numpy()
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        parts = [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        dimensions = pa.array(np.diff(ends).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], dimensions, pa.array(parts, pa.binary())], ["node", "copies", "label", "dimension", "vector"]
        )


def _units(vectors: list[bytes], dimension: int, kind: str) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(vectors), kind).astype(np.float64), dimension)


def _buckets(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, label, dimension, table, signature`` for each node (``node, label, dimension, vector``) and table."""
    for batch in batches:
        sizes = batch.column(2).to_numpy()
        for dimension in np.unique(sizes):
            rows = np.flatnonzero(sizes == dimension)
            part = batch.take(pa.array(rows))
            signatures = _signatures_of(_units(part.column(3).to_pylist(), int(dimension), kind))
            for table in range(TABLES):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(np.full(len(rows), table, np.int32)), pa.array(signatures[:, table].astype(np.int32))],
                    ["node", "label", "dimension", "table", "signature"],
                )


def _links_of(left: list[tuple], right: list[tuple] | None, table: int, kind: str) -> list[tuple[int, int, int]]:
    """``(node, links, root)`` for the nodes of one block that are linked in it and share no earlier table."""
    same = right is None
    sides = [left, left if same else right]
    nodes = [np.array([row[0] for row in side], np.int64) for side in sides]
    copies = [np.array([row[1] for row in side], np.int64) for side in sides]
    dimension = len(left[0][2]) // np.dtype(kind).itemsize
    units = [_units([row[2] for row in side], dimension, kind) for side in sides]
    signatures = [_signatures_of(unit) for unit in units] if table else []
    linked = units[0] @ units[1].T >= COSINE
    if same:
        np.fill_diagonal(linked, False)
    for earlier in range(table):
        linked &= signatures[0][:, earlier, None] != signatures[1][None, :, earlier]
    a, b = np.nonzero(linked)
    if not len(a):
        return []
    counts: dict[int, int] = {}
    for own, other, weight in ((nodes[0], linked, copies[1]),) if same else ((nodes[0], linked, copies[1]), (nodes[1], linked.T, copies[0])):
        total = other @ weight
        for i in np.flatnonzero(total):
            counts[int(own[i])] = counts.get(int(own[i]), 0) + int(total[i])
    roots = _roots(nodes[0][a], nodes[1][b])
    return [(node, n, roots[node]) for node, n in counts.items()]


def _roots(a: np.ndarray, b: np.ndarray) -> dict[int, int]:
    """Smallest node that the links ``a - b`` reach from each of their nodes."""
    names, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = index[: len(a)], index[len(a) :]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[a], root[b])
        fresh = root.copy()
        np.minimum.at(fresh, a, least)
        np.minimum.at(fresh, b, least)
        fresh = fresh[fresh]
        if np.array_equal(fresh, root):
            break
        root = fresh
    return dict(zip(names.tolist(), names[root].tolist(), strict=True))


def _compare(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block, from rows sorted by block (``bucket, first, second, table, side, node, copies, vector``)."""
    at, sides, out = None, ([], []), []

    def close() -> None:
        if at is not None:
            first, second, table = at[1], at[2], at[3]
            if first == second and len(sides[0]) > 1:
                out.extend(_links_of(sides[0], None, table, kind))
            elif first != second and sides[0] and sides[1]:
                out.extend(_links_of(sides[0], sides[1], table, kind))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])

    for batch in batches:
        for bucket, first, second, table, side, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if at != (bucket, first, second, table):
                close()
                at, sides = (bucket, first, second, table), ([], [])
            sides[side].append(row)
        yield flush()
    close()
    yield flush()


def _block_links(nodes: DataFrame) -> DataFrame:
    """Links of all blocks; vectors join the rows of their buckets only where these have other nodes in them."""
    kind = "<f4" if isinstance(nodes.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    nodes = nodes.mapInArrow(_packed, "node BIGINT, copies BIGINT, label STRING, dimension INT, vector BINARY")
    nodes = staged(nodes, "packed-vectors")
    signed = nodes.select("node", "label", "dimension", "vector").mapInArrow(
        partial(_buckets, kind), "node BIGINT, label STRING, dimension INT, table INT, signature INT"
    )
    placed = signed.select(F.concat_ws("|", "dimension", "table", "signature", "label").alias("bucket"), "table", "node")
    placed = staged(placed, "buckets")
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    dealt = (
        placed.join(sizes, "bucket")
        .withColumn("chunks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "bucket", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"), "table",
            (F.col("chunk") > F.col("other")).cast("int").alias("side"), "node",
        )
        .join(nodes.select("node", "copies", "vector"), "node")
        .select("bucket", "first", "second", "table", "side", "node", "copies", "vector")
    )
    block = ["bucket", "first", "second"]
    return dealt.repartition(*block).sortWithinPartitions(*block).mapInArrow(partial(_compare, kind), "node BIGINT, links BIGINT, root BIGINT")


def _floating(column: Column, df: DataFrame) -> Column:
    """Vectors of single precision as they are, all others in double precision."""
    kind = df.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return column if single else column.cast("array<double>")


def near_duplicate_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``embeddings`` (``vec_id, embedding, label``).

    Vectors with equal labels link at a cosine of ``COSINE`` or more.  A null label, and a vector that is null,
    empty, all zero or has null or non-finite components, links with nothing; so do vectors of different
    lengths.  Equal vectors are linked rows.  ``component_id`` is the smallest id that links reach, the row's own
    included; null ids count for none and are not kept.  Ids may repeat; no rows give no rows; further
    columns are not looked at.
    """
    rows = pick(embeddings, "vec_id", "embedding", "label").select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        _floating(F.col("embedding"), embeddings).alias("embedding"),
        F.col("label").cast("string").alias("label"),
    )
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("embedding", F.when(F.col("label").isNotNull() & fine & some, F.col("embedding")))
    nodes = (
        rows.where("embedding IS NOT NULL")
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = staged(nodes, "vectors")
    found = staged(_block_links(nodes.select("node", "copies", "label", "embedding")), "vector-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        nodes.join(totals, "node", "left")
        .join(roots, "node", "left")
        .select("label", "embedding", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(known.join(smallest, "root").select("label", "embedding", "n_links", "component_id"), "vector-groups")
    joined = null_safe_join(rows, named, ["label", "embedding"], "left")
    component = F.coalesce(F.when(F.col("n_links").isNotNull(), F.col("component_id")), F.col("vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
