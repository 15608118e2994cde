"""A Merkle manifest of a dataset, and proofs of its documents from octopus multiproofs.

Every document is a leaf.  The leaves of a language, by id, make one tree; the roots of the languages make the tree
on top.  A node is the hash of its children, two neighbours of the level below, or the last one alone.  Levels are hashed in
blocks of ``2 ** BLOCK_BITS`` neighbours, so a tree of any size is built in one round of grouping for every ``BLOCK_BITS``
levels.

Proofs are made for the requested leaves, ``CHUNK_LEAVES`` neighbours of a tree at a time.  A chunk first works out, from places
alone, the least set of nodes that its leaves cannot give: siblings on the way to the top root that no requested leaf of the chunk
lies below.  These few are fetched by one join.  The nodes in between come from the chunk's own leaves, and each leaf's proof is
read off them, so what many proofs share is fetched and hashed once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import null_safe_join, pick, staged_at
from corpusflow.llm.placing import placed
from corpusflow.storage import drop_table

BLOCK_BITS = 12
CHUNK_LEAVES = 4096
#: Number of the tree over the roots of the others.
TOP = -1

NODES = "tree BIGINT, level INT, at BIGINT, width BIGINT, hash STRING"
SIBLINGS = "ARRAY<STRUCT<left: STRING, right: STRING>>"


def joined_hash(*parts: Column) -> Column:
    """Lower-case hexadecimal sha256 of the parts, one after another; a null part is left out."""
    return F.sha2(F.concat(*[F.coalesce(part, F.lit("")) for part in parts]), 256)


def leaf_hash(*values: Column) -> Column:
    """Hash of a row's values: ``-`` of a null, else its length in UTF-8 bytes, a colon, and itself."""
    texts = [value.cast("string") for value in values]
    return joined_hash(*[F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts])


@dataclass
class Manifest:
    """``leaves``: the given rows with ``tree, at``; ``nodes``: ``tree, level, at, width, hash``, where ``width`` is that of the level.

    ``trees``: ``tree, lang, width, subroot``.  ``root`` is null of no rows.
    """

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    n_trees: int
    root: str | None
    paths: list[str] = field(default_factory=list)

    def drop(self) -> None:
        """Delete the tables once nothing reads them any more."""
        for path in self.paths:
            drop_table(self.leaves.sparkSession, path)


def _parents(hashes: list[str]) -> list[str]:
    return [hashlib.sha256("".join(hashes[i : i + 2]).encode()).hexdigest() for i in range(0, len(hashes), 2)]


def _hash_blocks(base: int):
    """Levels above neighbouring nodes of level ``base``; the nodes themselves only where they are leaves."""

    def levels(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        tree, width = table["tree"][0].as_py(), table["width"][0].as_py()
        at, hashes, level = table["at"][0].as_py(), table["hash"].to_pylist(), base
        found = [] if base else [(level, at, width, hashes)]
        while width > 1 and level < base + BLOCK_BITS:
            hashes, at, width, level = _parents(hashes), at >> 1, (width + 1) >> 1, level + 1
            found.append((level, at, width, hashes))
        sizes = [len(hashes) for *_, hashes in found]
        columns = [
            pa.array(np.full(sum(sizes), tree)),
            pa.array(np.repeat([level for level, *_ in found], sizes).astype(np.int32)),
            pa.array(np.concatenate([np.arange(n) + at for (_, at, *_), n in zip(found, sizes, strict=True)] or [np.zeros(0, np.int64)])),
            pa.array(np.repeat([width for _, _, width, _ in found], sizes).astype(np.int64)),
            pa.array([value for *_, hashes in found for value in hashes], pa.string()),
        ]
        return pa.table(columns, ["tree", "level", "at", "width", "hash"])

    return levels


def _tree_nodes(bottom: DataFrame, widest: int) -> tuple[DataFrame, list[str]]:
    """All nodes above and with ``bottom`` (``tree, at, width, hash``), in rounds of ``BLOCK_BITS`` levels."""
    nodes, paths, base = None, [], 0
    while True:
        blocks = bottom.withColumn("block", F.shiftright("at", BLOCK_BITS)).groupBy("tree", "block")
        made, path = staged_at(blocks.applyInArrow(_hash_blocks(base), NODES), "merkle-nodes")
        paths.append(path)
        nodes = made if nodes is None else nodes.unionByName(made)
        base, widest = base + BLOCK_BITS, -(-widest >> BLOCK_BITS) if widest > 1 else 1
        if widest <= 1:
            return nodes, paths
        bottom = made.where((F.col("level") == base) & (F.col("width") > 1)).select("tree", "at", "width", "hash")


def build_manifest(rows: DataFrame, key: str = "doc_id", group: str = "lang", leaf: str = "leaf") -> Manifest:
    """The trees over ``rows``, whose column ``leaf`` holds their hashes; further columns are kept.

    Leaves are ordered by ``key``, nulls first, equal ones by ``leaf``; trees by ``group``, null first, else bytewise.  A
    group of any size is built in blocks that tasks share.
    """
    order = [F.col(group).asc_nulls_first(), F.col(key).asc_nulls_first(), F.col(leaf)]
    places, places_path = placed(rows, order, label="merkle-places")
    groups = places.groupBy(group).agg(F.min("place").alias("first"), F.count("*").alias("width"))
    groups, groups_path = placed(groups, [F.col(group).asc_nulls_first()], label="merkle-groups")
    groups = groups.withColumnRenamed("place", "tree")
    leaves, leaves_path = staged_at(
        null_safe_join(places, groups, [group], "inner").select(*rows.columns, "tree", (F.col("place") - F.col("first")).alias("at"), "width"), "merkle-leaves"
    )
    n_trees, widest = groups.agg(F.count("*"), F.max("width")).first()
    nodes, paths = _tree_nodes(leaves.select("tree", "at", "width", F.col(leaf).alias("hash")), widest or 1)
    subroots = nodes.where("width = 1").select("tree", F.col("hash").alias("subroot"))
    trees, trees_path = staged_at(groups.select("tree", F.col(group).alias("lang"), "width").join(subroots, "tree"), "merkle-trees")
    top = trees.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(n_trees).cast("bigint").alias("width"), F.col("subroot").alias("hash"))
    top, top_paths = _tree_nodes(top, n_trees)
    root = top.where("width = 1").first()
    for path in (places_path, groups_path):
        drop_table(rows.sparkSession, path)
    return Manifest(leaves, nodes.unionByName(top), trees, n_trees, root and root["hash"], [leaves_path, trees_path, *paths, *top_paths])


def missing_nodes(at: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """``level, places`` of the nodes that the leaves ``at`` of a tree do not give, but their proofs need; the least there can be."""
    known, level = np.unique(at), 0
    while width > 1:
        siblings = known ^ 1
        siblings = siblings[siblings < width]
        yield level, np.setdiff1d(siblings, known)
        known, width, level = np.unique(known >> 1), (width + 1) >> 1, level + 1


def _wanted(n_trees: int):
    def coordinates(table: pa.Table) -> pa.Table:
        tree, chunk, width = (table[name][0].as_py() for name in ("tree", "chunk", "width"))
        needs = [(tree, level, at) for level, at in missing_nodes(table["at"].to_numpy(), width)]
        needs += [(TOP, level, at) for level, at in missing_nodes(np.array([tree]), n_trees)]
        sizes = [len(at) for *_, at in needs]
        return pa.table(
            [
                pa.array(np.full(sum(sizes), tree)),
                pa.array(np.full(sum(sizes), chunk)),
                pa.array(np.repeat([t for t, *_ in needs], sizes).astype(np.int64)),
                pa.array(np.repeat([level for _, level, _ in needs], sizes).astype(np.int32)),
                pa.array(np.concatenate([at for *_, at in needs] or [np.zeros(0, np.int64)]).astype(np.int64)),
            ],
            ["tree", "chunk", "node_tree", "level", "node_at"],
        )

    return coordinates


def _climb(at: np.ndarray, hashes: np.ndarray, width: int, fetched: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Siblings to the left and to the right of each of ``at`` on every level, and the root; nodes in between are hashed once."""
    order = np.unique(at, return_index=True)
    known, values = order[0], hashes[order[1]]
    lefts, rights, level, path = [], [], 0, at
    while width > 1:
        extra, extra_values = fetched.get(level, (np.zeros(0, np.int64), np.zeros(0, object)))
        places = np.concatenate([known, extra])
        by_place = np.argsort(places)
        places, values = places[by_place], np.concatenate([values, extra_values])[by_place]
        sibling = path ^ 1
        found = values[np.minimum(np.searchsorted(places, sibling), len(places) - 1)]
        lefts.append(np.where(path & 1 == 1, found, None))
        rights.append(np.where((path & 1 == 0) & (sibling < width), found, None))
        parents = np.unique(known >> 1)
        first = np.searchsorted(places, parents << 1)
        two = (parents << 1) + 1 < width
        joined = (values[a] + (values[a + 1] if b else "") for a, b in zip(first, two, strict=True))
        values = np.array([hashlib.sha256(text.encode()).hexdigest() for text in joined], object)
        known, path, width, level = parents, path >> 1, (width + 1) >> 1, level + 1
    return lefts, rights, values[0]


def _expand(names: list[str], leaf: str, n_trees: int):
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def proofs(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        if not leaves.num_rows:
            return pa.table([*[leaves[name] for name in names], pa.array([], kind)], [*names, "siblings"])
        n, tree = leaves.num_rows, leaves["tree"][0].as_py()
        fetched: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {tree: {}, TOP: {}}
        trees, levels, places = (nodes[name].to_numpy() for name in ("node_tree", "level", "node_at"))
        values = np.array(nodes["hash"].to_pylist(), object)
        for of in fetched:
            for level in np.unique(levels[trees == of]).tolist():
                these = (trees == of) & (levels == level)
                fetched[of][level] = places[these], values[these]
        lefts, rights, subroot = _climb(leaves["at"].to_numpy(), np.array(leaves[leaf].to_pylist(), object), leaves["width"][0].as_py(), fetched[tree])
        top_lefts, top_rights, _ = _climb(np.array([tree]), np.array([subroot], object), n_trees, fetched[TOP])
        lefts += [np.repeat(value, n) for value in top_lefts]
        rights += [np.repeat(value, n) for value in top_rights]
        steps = len(lefts)
        sides = [pa.array(np.stack(side, axis=1).ravel() if steps else [], pa.string()) for side in (lefts, rights)]
        pairs = pa.StructArray.from_arrays(sides, ["left", "right"])
        siblings = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * steps, pa.int32()), pairs)
        return pa.table([*[leaves[name] for name in names], siblings], [*names, "siblings"])

    return proofs


def prove(manifest: Manifest, requested: DataFrame, leaf: str = "leaf") -> DataFrame:
    """``requested``, some or all rows of ``manifest.leaves``, each with its proof: ``siblings``, level by level up to the root.

    A step holds the sibling to the left or to the right, or neither where a node is alone.
    """
    chunks = requested.withColumn("chunk", F.floor(F.col("at") / CHUNK_LEAVES).cast("bigint"))
    schema = "tree BIGINT, chunk BIGINT, node_tree BIGINT, level INT, node_at BIGINT"
    wanted = chunks.select("tree", "chunk", "at", "width").groupBy("tree", "chunk").applyInArrow(_wanted(manifest.n_trees), schema)
    nodes = manifest.nodes.select(F.col("tree").alias("node_tree"), "level", F.col("at").alias("node_at"), "hash")
    fetched = wanted.join(nodes, ["node_tree", "level", "node_at"])
    names = requested.columns
    kind = T.StructType([*requested.schema.fields, T.StructField("siblings", T.DataType.fromDDL(SIBLINGS))])
    return chunks.groupBy("tree", "chunk").cogroup(fetched.groupBy("tree", "chunk")).applyInArrow(_expand(names, leaf, manifest.n_trees), kind)


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(siblings, leaf, lambda value, step: joined_hash(step["left"], value, step["right"]))


def document_leaves(documents: DataFrame) -> DataFrame:
    """``doc_id, lang, leaf, tampered`` of documents; ``tampered`` is the leaf of one more character, null if ``n_chars`` is."""
    rows = pick(documents, "doc_id", "source", "lang", "n_chars", "text")
    values = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [F.col("n_chars") + 1 if i == 3 else value for i, value in enumerate(values)]
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    return rows.select("doc_id", "lang", leaf_hash(*values).alias("leaf"), F.when(hit, leaf_hash(*more)).alias("tampered"))


def prove_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, leaf, presented, subroot, root, siblings, folded_root, verified`` of every document.

    ``presented`` is the leaf as a tampering hand shows it: where 7 divides the crc32 of the decimal id, ``n_chars`` is one more,
    elsewhere, and of null ids and null ``n_chars``, nothing is changed.  Null values are hashed as such; repeated rows are leaves of
    their own with equal hashes; rows of one id are ordered by their hashes.  No documents give no rows.
    """
    leaves, path = staged_at(document_leaves(documents), "merkle-rows")
    manifest = build_manifest(leaves)
    drop_table(documents.sparkSession, path)
    proofs = prove(manifest, manifest.leaves)
    shown = F.coalesce("tampered", "leaf")
    # one row a language: Spark broadcasts it if it is small
    rows = proofs.join(manifest.trees.select("tree", "subroot"), "tree")
    rows = rows.select("doc_id", "leaf", shown.alias("presented"), "subroot", F.lit(manifest.root).alias("root"), "siblings", folded(shown, F.col("siblings")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_hash(siblings: Column) -> Column:
    """Hash of all siblings of a proof, in order."""
    return F.sha2(F.array_join(F.transform(siblings, lambda step: F.coalesce(step["left"], step["right"], F.lit(""))), ""), 256)
