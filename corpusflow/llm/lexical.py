"""Ranked lexical search: the best documents for each of a set of items, by branch and bound over document FP-trees.

Documents are cut into terms once.  Only terms of the items matter for scores, so each document keeps its term vector restricted to
these, the most frequent term first.  Tasks sort the vectors of some thousand documents and lay them into a trie,
where documents that begin alike share a path; every subtree knows the largest frequency of each term in it and the
smallest length norm.  These give the most that a document of the subtree can score, so an item walks down the trie
depth first, best child first, and leaves out every subtree that cannot reach its ten best so far.  The ten best of all
tasks are merged.  Nothing is left out that could count: a bound equal to the tenth score is still followed.

Items are read in batches of about ``BATCH_BYTES`` of text, each collected and broadcast on its own, so what tasks hold is
bounded however many items there are; every batch is one more pass over the documents.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import pick, staged_at
from corpusflow.storage import drop_table

TOP = 10
BATCH_BYTES = 4 << 20
#: Documents and postings of a tree at most, and documents of a subtree that is not divided any further.
TREE_DOCUMENTS, TREE_POSTINGS, LEAF_DOCUMENTS = 8192, 4 << 20, 48
#: Maxima that a tree keeps, about: with very many terms its subtrees are left undivided sooner.
TREE_MAXIMA = 8 << 20
#: Bytes of a text that are cut into terms at once, and postings of a batch of rows.
BYTES_AT_ONCE, POSTINGS_AT_ONCE = 1 << 20, 1 << 18
#: Fixed values of the score.
SCALE, STEEPNESS, LENGTH_SHARE = 1_000_000_000, 8, 90

_KEPT = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TABLE = bytes(byte + 32 if 65 <= byte <= 90 else byte if byte in _KEPT else 32 for byte in range(256))


def term_counts(data: bytes) -> Counter:
    """How often each term of a text comes; a text of any length is cut a piece at a time."""
    data = data.translate(_TABLE)
    if len(data) <= BYTES_AT_ONCE:
        return Counter(data.split())
    counts, at = Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + BYTES_AT_ONCE)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


@dataclass(frozen=True)
class Query:
    """Items of a batch: ``terms[k]`` are the numbers of the terms of ``item_ids[k]``; ``vocabulary`` numbers the terms."""

    item_ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def read_items(rows: list) -> Query:
    """The items ``(item_id, text)`` of a batch; a null text is like an empty one."""
    vocabulary: dict[bytes, int] = {}
    terms = [sorted({vocabulary.setdefault(term, len(vocabulary)) for term in term_counts((text or "").encode())}) for _, text in rows]
    return Query([item_id for item_id, _ in rows], [np.array(these, np.int64) for these in terms], vocabulary)


def _bytes(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _restricted(query):
    """``doc_id, n, terms, counts``: length of each document and its vector of the query's terms."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = query.value.vocabulary
        kept = vocabulary.keys()
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = term_counts(_bytes(text))
                shared = [term for term in counts if term in kept]
                held.append((doc_id, counts.total(), [vocabulary[term] for term in shared], [counts[term] for term in shared]))
                size += len(shared)
                if size > POSTINGS_AT_ONCE:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)

    return rows


def _batch(held: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*held, strict=True), kinds, strict=True)], ["doc_id", "n", "terms", "counts"])


@dataclass(frozen=True)
class Corpus:
    """Rank by document frequency and weight of every term of a query, and what length norms need."""

    documents: int
    words: int
    rank: np.ndarray
    weight: np.ndarray


def gains(weight: np.ndarray, counts: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What terms add to scores."""
    return weight * ((SCALE * counts) // (1000 * counts + STEEPNESS * norm))


class Tree:
    """A trie over the restricted vectors of some documents.

    Documents are sorted by their vectors of ranks.  A node is a run of documents that share the first ranks, ``depth`` of
    them; its children part it by the next.  Nodes come before their children; those without are scored document by document.
    """

    def __init__(self, doc_ids: list, norms: np.ndarray, starts: np.ndarray, ranks: np.ndarray, counts: np.ndarray) -> None:
        vectors = [ranks[a:b].astype(">u4").tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        order = sorted(range(len(vectors)), key=vectors.__getitem__)
        lengths = np.diff(starts)[order]
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(starts[:-1][order] - self.starts[:-1], lengths) + np.arange(self.starts[-1])
        self.ranks, self.counts, self.norms = ranks[at], counts[at], norms[order]
        self.doc_ids = [doc_ids[i] for i in order]
        # ranks that come here, numbered anew; the last column of the maxima stays zero
        self.local = np.unique(self.ranks)
        self.columns = np.searchsorted(self.local, self.ranks)
        # a node for every third of a leaf's documents is more than there are
        self.leaf = max(LEAF_DOCUMENTS, 3 * len(doc_ids) * len(self.local) // TREE_MAXIMA)
        self._divide([vectors[i] for i in order])

    def _divide(self, vectors: list[bytes]) -> None:
        shared = [0] * len(vectors)
        for i in range(1, len(vectors)):
            a, b = vectors[i - 1], vectors[i]
            n = min(len(a), len(b)) // 4
            same = np.flatnonzero(np.frombuffer(a, ">u4", n) != np.frombuffer(b, ">u4", n))
            shared[i] = int(same[0]) if len(same) else n
        shared = np.array(shared)
        self.spans, self.children = [(0, len(vectors))], [[]]
        open_nodes = [0]
        while open_nodes:
            node = open_nodes.pop()
            low, high = self.spans[node]
            if high - low <= self.leaf:
                continue
            inside = shared[low + 1 : high]
            cuts = np.flatnonzero(inside == inside.min()) + low + 1
            # equal vectors cannot be parted by a term, so they are by number
            if len(vectors[low]) == 4 * inside.min() == len(vectors[high - 1]):
                cuts = np.arange(low + self.leaf, high, self.leaf)
            edges = [low, *cuts.tolist(), high]
            for a, b in self._gathered(edges):
                self.children[node].append(len(self.spans))
                open_nodes.append(len(self.spans))
                self.spans.append((a, b))
                self.children.append([])
        self.most = np.zeros((len(self.spans), len(self.local) + 1), np.int64)
        self.least_norm = np.array([self.norms[a:b].min() for a, b in self.spans])
        for node in range(len(self.spans) - 1, -1, -1):
            if self.children[node]:
                self.most[node] = self.most[self.children[node]].max(axis=0)
            else:
                a, b = self.starts[list(self.spans[node])]
                np.maximum.at(self.most[node], self.columns[a:b], self.counts[a:b])

    def _gathered(self, edges: list[int]) -> Iterator[tuple[int, int]]:
        """Neighbouring branches that are small together are one node, so that nodes stay few."""
        begin = edges[0]
        for a, b in zip(edges[1:-1], edges[2:], strict=True):
            if b - begin > self.leaf and a > begin:
                yield begin, a
                begin = a
        yield begin, edges[-1]

    def search(self, ranks: np.ndarray, weights: np.ndarray, best: list[tuple]) -> int:
        """Put the documents that belong there into ``best``: ``(-score, no id, doc_id)``, best first; how many were scored."""
        place = np.searchsorted(self.local, ranks)
        here = place < len(self.local)
        here[here] = self.local[place[here]] == ranks[here]
        if not here.any():
            return 0
        columns, weights, scored = place[here], weights[here], 0
        bounds = gains(weights, self.most[:, columns], self.least_norm[:, None]).sum(axis=1)
        of_column = np.zeros(len(self.local) + 1, np.int64)
        of_column[columns] = weights
        stack = [0]
        while stack:
            node = stack.pop()
            if bounds[node] <= 0 or (len(best) == TOP and bounds[node] < -best[-1][0]):
                continue
            if self.children[node]:
                stack += sorted(self.children[node], key=bounds.__getitem__)
                continue
            low, high = self.spans[node]
            starts = self.starts[low : high + 1]
            a, b = starts[0], starts[-1]
            of_posting = of_column[self.columns[a:b]]
            hit = np.flatnonzero(of_posting)
            document = np.searchsorted(starts, hit + a, side="right") - 1
            scores = np.zeros(high - low, np.int64)
            np.add.at(scores, document, gains(of_posting[hit], self.counts[a:b][hit], self.norms[low:high][document]))
            scored += high - low
            for i in np.flatnonzero(scores).tolist():
                doc_id = self.doc_ids[low + i]
                entry = (-int(scores[i]), doc_id is None, doc_id or 0)
                if len(best) < TOP or entry < best[-1]:
                    insort(best, entry)
                    del best[TOP:]
        return scored


def _searched(query, corpus):
    """``item, doc_id, score``: the best documents of a task for each item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        about, items = corpus.value, query.value.terms
        ranks = [about.rank[terms] for terms in items]
        weights = [about.weight[terms] for terms in items]
        best: list[list[tuple]] = [[] for _ in items]
        for doc_ids, lengths, starts, terms, counts in _tree_sized(batches):
            norms = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * about.documents) // about.words
            # every vector from its most frequent term on
            of_posting = about.rank[terms]
            document = np.repeat(np.arange(len(lengths)), np.diff(starts))
            order = np.lexsort((of_posting, document))
            tree = Tree(doc_ids, norms, starts, of_posting[order], counts[order])
            for item in range(len(items)):
                tree.search(ranks[item], weights[item], best[item])
        found = [(item, None if no_id else doc_id, -score) for item, entries in enumerate(best) for score, no_id, doc_id in entries]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*found, strict=True)], ["item", "doc_id", "score"])

    return rows


def _tree_sized(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as ids, lengths, starts of their postings, terms and counts, of as many documents as a tree takes."""
    held, documents, postings = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            held.append(part)
            documents += part.num_rows
            postings += len(part.column(2).flatten())
            if documents >= TREE_DOCUMENTS or postings >= TREE_POSTINGS:
                yield _columns(held)
                held, documents, postings = [], 0, 0
    if documents:
        yield _columns(held)


def _columns(held: list[pa.RecordBatch]) -> tuple:
    table = pa.Table.from_batches(held).combine_chunks()
    lists = [table[name].chunk(0) for name in ("terms", "counts")]
    starts = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy())])
    return table["doc_id"].to_pylist(), table["n"].to_numpy(), starts, *[values.flatten().to_numpy() for values in lists]


def _about(vectors: DataFrame, terms: int) -> Corpus:
    """Counts over all documents; the document frequencies are one number a term of the query."""
    documents, words = vectors.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    frequency = np.zeros(terms, np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[term] = n
    rank = np.empty(terms, np.int64)
    rank[np.lexsort((np.arange(terms), -frequency))] = np.arange(terms)
    weight = [floor(1000 * log((2 * documents + 2) / (2 * n + 1))) for n in frequency.tolist()]
    return Corpus(documents, words or 1, rank, np.array(weight, np.int64))


def search_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``TOP`` best ``documents`` (``doc_id, text``) for each of ``items`` (``item_id, text``).

    An item is its id and text: repeated rows of it are one.  Documents are rows: of repeated ones each has its rank.  Null
    texts are like empty ones: without terms, found by nothing and finding nothing.  Equal scores are ranked by id, a null id last.
    No documents or no items give no rows.
    """
    spark = documents.sparkSession
    asked = pick(items, "item_id", "text").distinct()
    size = asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    batches = -(-size // BATCH_BYTES) or 1
    texts, found, paths = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), [], []
    for number in range(batches):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == number) if batches > 1 else asked
        # about BATCH_BYTES, however many items there are
        query = read_items([tuple(row) for row in rows.collect()])
        shared = spark.sparkContext.broadcast(query)
        vectors, path = staged_at(texts.mapInArrow(_restricted(shared), "doc_id BIGINT, n BIGINT, terms ARRAY<INT>, counts ARRAY<BIGINT>"), "term-vectors")
        about = spark.sparkContext.broadcast(_about(vectors, len(query.vocabulary)))
        of_tasks = vectors.where("size(terms) > 0").mapInArrow(_searched(shared, about), "item BIGINT, doc_id BIGINT, score BIGINT")
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = of_tasks.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= TOP)
        kind = asked.schema["item_id"].dataType
        names = spark.createDataFrame(list(enumerate(query.item_ids)), f"item BIGINT, item_id {kind.simpleString()}")
        best, best_path = staged_at(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "best-documents")
        found.append(best)
        paths.append(path)
    for path in paths:
        drop_table(spark, path)
    return reduce(DataFrame.unionByName, found)
