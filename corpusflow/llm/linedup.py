"""Passages that repeat across documents: overlapping pairs by shared lines, patience alignment, cuts in the later one.

A line is a run of ``BLOCK_WORDS`` words; one starts at every word, so a passage of as many words or more is found wherever
its text is broken.  A row for every line would be a row for every word; therefore each line names an anchor first, the smallest
hash of the ``GRAM_WORDS``-word grams inside it.  Equal lines have equal anchors wherever they stand, neighbours mostly
share theirs, and only lines whose anchor comes in two documents are written.

A document is paired, line by line, with the first holder of that line: a line that a third of all documents have gives each
of them one partner and no pairs among them, and no line is without one.  Each pair is aligned by patience diff: lines that come once
among those of the pair, a longest run of them that is in order in both texts, grown word by word as far as the texts agree.
What is aligned in this way is cut from the later document.  Common blocks that cross the alignment are ``moved``; they
are cut too unless the caller keeps them.  The first holder of a line never loses it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import pick, small_batches, staged, staged_at
from corpusflow.storage import drop_table

#: Words of a line, and of the shortest block that is deleted.
BLOCK_WORDS = 25
#: Words of the grams that anchor a line.  Longer ones are rarer and more of them are written.
GRAM_WORDS = 8

#: Odd multipliers of the hashes of words, by bytes, and of lines, by words; all modulo 2 ** 64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: 0 for ASCII white space, else 1.
_IN_WORDS = bytes(byte != 32 and not 9 <= byte <= 13 for byte in range(256))
#: Bytes that are hashed together.
BYTES_AT_ONCE = 1 << 20
#: Rows that a task gathers before it passes them on.
ROWS_AT_ONCE = 100_000


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** n`` modulo 2 ** 64, at least."""
    return _powers(base, 1 << max(16, n.bit_length()))


_INVERSE_BYTE_BASE, _INVERSE_WORD_BASE = (pow(base, -1, 1 << 64) for base in (BYTE_BASE, WORD_BASE))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end, in bytes; words are what ASCII white space parts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = np.frombuffer(data.translate(_IN_WORDS), bool)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    hashes, first = np.zeros(len(starts), np.uint64), 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + BYTES_AT_ONCE, side="right")))
        part = np.frombuffer(data, np.uint8)[starts[first] : ends[last - 1]].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * powers(BYTE_BASE, len(part))[: len(part)])])
        a, b = starts[first:last] - starts[first], ends[first:last] - starts[first]
        hashes[first:last] = (sums[b] - sums[a]) * powers(_INVERSE_BYTE_BASE, len(part))[a]
        first = last
    return _mixed(hashes)


def _sums(data: bytes) -> np.ndarray | None:
    """Running sums of the hashes of words, from which those of all grams come; none for less than a line."""
    starts, ends = words_of(data)
    n = len(starts)
    if n < BLOCK_WORDS:
        return None
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_word_hashes(data, starts, ends) * powers(WORD_BASE, n)[:n])])


def _grams(sums: np.ndarray, words: int) -> np.ndarray:
    n = len(sums) - words
    return _mixed((sums[words:] - sums[:-words]) * powers(_INVERSE_WORD_BASE, len(sums) - 1)[:n]).view(np.int64)


def _anchors(sums: np.ndarray) -> np.ndarray:
    # minima over 1, 2, 4, ... grams; the last two overlap
    least, over = _grams(sums, GRAM_WORDS), 1
    while over < BLOCK_WORDS - GRAM_WORDS + 1:
        step = min(over, BLOCK_WORDS - GRAM_WORDS + 1 - over)
        least, over = np.minimum(least[:-step], least[step:]), over + step
    return least


def distinct_anchors(data: bytes) -> np.ndarray:
    """The anchors of the lines of a text, each once."""
    sums = _sums(data)
    if sums is None:
        return np.zeros(0, np.int64)
    least = _anchors(sums)
    # neighbours mostly share theirs
    return np.unique(least[np.append(True, least[1:] != least[:-1])])


def line_table(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and anchor of the line of ``BLOCK_WORDS`` words at each word of a text that has one."""
    sums = _sums(data)
    if sums is None:
        return (np.zeros(0, np.int64),) * 2
    return _grams(sums, BLOCK_WORDS), _anchors(sums)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``anchor, document`` for each distinct anchor of each text."""
    def rows(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        for document, text in zip(batch.column(0).to_numpy(), batch.column(1), strict=True):
            anchors = distinct_anchors(text.as_buffer().to_pybytes()) if text.is_valid else ()
            if len(anchors):
                yield [anchors, np.full(len(anchors), document)]

    return _gathered(batches, rows, ["anchor", "document"])


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``line, doc_id, document, start`` of the lines with one of the given anchors."""
    def rows(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        ids, documents = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for doc_id, document, text, shared in zip(ids, documents, batch.column(2), batch.column(3), strict=True):
            lines, anchors = line_table(text.as_buffer().to_pybytes())
            wanted = np.sort(shared.values.to_numpy())
            at = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, anchors), len(wanted) - 1)] == anchors)
            yield [lines[at], np.full(len(at), doc_id), np.full(len(at), document), at]

    return _gathered(batches, rows, ["line", "doc_id", "document", "start"])


def _gathered(batches, rows, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of the columns that ``rows`` gives for the texts of a batch."""
    held: list[list[np.ndarray]] = []
    n = 0
    for batch in batches:
        for columns in rows(batch):
            held.append(columns)
            n += len(columns[0])
            if n > ROWS_AT_ONCE:
                yield _as_batch(held, names)
                held, n = [], 0
    if held:
        yield _as_batch(held, names)


def _as_batch(held: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*held, strict=True)], names)


def _increasing(values: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing run of ``values``."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        k = bisect_left(tails, value)
        before[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(value)
            at.append(i)
        else:
            tails[k], at[k] = value, i
    run, i = [], at[-1] if at else -1
    while i >= 0:
        run.append(i)
        i = before[i]
    return run[::-1]


#: A common block: first word and number of words, the partner's hash and the first word there, and whether it crosses the alignment.
BLOCK = pa.struct([("start", pa.int64()), ("words", pa.int64()), ("partner", pa.int64()), ("partner_start", pa.int64()), ("moved", pa.bool_())])
BLOCKS = "ARRAY<STRUCT<start: BIGINT, words: BIGINT, partner: BIGINT, partner_start: BIGINT, moved: BOOLEAN>>"


def align(own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row, number of rows and ``moved`` of each common block of two texts.

    ``own`` are the places, ascending, of the lines of one text that the other has, ``other`` their places there.
    """
    rows = len(own)
    edge = np.append(True, (np.diff(own) != 1) | (np.diff(other) != 1))
    first = np.flatnonzero(edge)
    count = np.diff(np.append(first, rows))
    if len(first) == 1:
        return first, count, np.zeros(1, bool)
    # patience: lines that come once, a longest run of them in order; the blocks they stand in are aligned whole
    values, at, times = np.unique(other, return_inverse=True, return_counts=True)
    once = np.flatnonzero(times[at] == 1)
    chain = once[_increasing(other[once].tolist())]
    moved = np.ones(len(first), bool)
    moved[np.searchsorted(first, chain, side="right") - 1] = False
    return first, count, moved


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``document, blocks`` from ``document, lines``: each document aligned with each of its partners."""
    for batch in batches:
        lines = batch.column(1)
        ends = lines.offsets.to_numpy()
        partner, place = (lines.values.field(i).to_numpy() for i in range(2))
        own, other = place >> 32, place & 0xFFFFFFFF
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        counts = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            order = a + np.lexsort((own[a:b], partner[a:b]))
            n = 0
            for part in np.split(order, np.flatnonzero(np.diff(partner[order])) + 1):
                first, count, moved = align(own[part], other[part])
                found = own[part][first], count + BLOCK_WORDS - 1, partner[part][first], other[part][first], moved
                for column, values in zip(columns, found, strict=True):
                    column.append(values)
                n += len(first)
            counts.append(n)
        if counts:
            values = pa.StructArray.from_arrays([pa.array(np.concatenate(column)) for column in columns], fields=list(BLOCK))
            blocks = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), blocks], ["document", "blocks"])


def _rows(documents: DataFrame) -> DataFrame:
    rows = pick(documents, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("doc_id"), "text")
    return rows.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("document"), "text")


def common_blocks(documents: DataFrame) -> DataFrame:
    """``document, first_id, copied, blocks`` of the texts of ``documents`` (``doc_id, text``) that repeat passages of earlier ones.

    ``document`` is the hash of the text and ``first_id`` the smallest id that has it; ``copied`` says whether another id has it
    too.  ``blocks`` are those of ``BLOCK`` that the text shares with its partners, or null.  Blocks with different partners may overlap.
    Earlier means a smaller ``first_id``, of equal ids a smaller hash.  A null id is later than all others.  Null texts
    and those of fewer words than a line have no blocks.
    """
    rows = _rows(documents)
    # tables that are read twice are written once, and dropped when they are no longer needed; what may have a key
    # of very many rows is joined with a table, so that Spark can split the key
    anchors, anchors_path = staged_at(rows.select("document", "text").mapInArrow(_anchor_rows, "anchor BIGINT, document BIGINT"), "anchors")
    common = anchors.groupBy("anchor").agg(F.min("document").alias("a"), F.max("document").alias("b")).where("a <> b").select("anchor")
    common, common_path = staged_at(common, "common-anchors")
    texts = rows.groupBy("document").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    texts, texts_path = staged_at(texts.select("document", "first_id", (F.col("first_id") != F.col("last_id")).alias("copied")), "texts")
    shared = anchors.join(common, "anchor").groupBy("document").agg(F.collect_set("anchor").alias("shared"))
    # of copies the first alone is looked at
    shared = shared.join(texts.select("document", F.col("first_id").alias("doc_id")), "document").hint("shuffle_hash")
    lines = rows.join(shared, ["document", "doc_id"]).select("doc_id", "document", "text", "shared")
    lines, lines_path = staged_at(lines.mapInArrow(_line_rows, "line BIGINT, doc_id BIGINT, document BIGINT, start BIGINT"), "lines")
    for path in (anchors_path, common_path):
        drop_table(documents.sparkSession, path)
    first = lines.groupBy("line").agg(F.min(F.struct("doc_id", "document", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select("line", F.col("first.document").alias("partner"), F.col("first.start").alias("there"))
    first, first_path = staged_at(first, "first-holders")
    # a document's lines that earlier ones have: as many as it has words at most
    later = lines.join(first, "line").where("document <> partner")
    place = F.shiftleft("start", 32).bitwiseOR(F.col("there"))
    later = later.select("document", F.struct("partner", place.alias("place")).alias("line")).groupBy("document").agg(F.collect_list("line").alias("lines"))
    blocks = later.mapInArrow(_aligned, f"document BIGINT, blocks {BLOCKS}")
    found = staged(texts.join(blocks, "document", "left").where("copied OR blocks IS NOT NULL"), "common-blocks")
    for path in (texts_path, lines_path, first_path):
        drop_table(documents.sparkSession, path)
    return found


def _has_words(text: Column, least: int) -> Column:
    """Whether a text has so many words; null has none.  What comes after them, or an empty piece before them, is no more than two pieces."""
    pieces = F.split(text, r"[\x20\x09-\x0D]+", least + 2)
    return F.coalesce(F.size(F.filter(pieces, lambda word: word != "")), F.lit(0)) >= least


@F.arrow_udf(T.StringType())
def cut_blocks(texts: pa.Array, begins: pa.Array, counts: pa.Array) -> pa.Array:
    """Texts without the blocks of so many words from the given words on; blocks may overlap."""
    def cut(text: pa.Scalar, begin: pa.Scalar, count: pa.Scalar) -> str | None:
        if not text.is_valid or not begin.is_valid or not len(begin):
            return text.as_py()
        data, begin, count = text.as_buffer().to_pybytes(), begin.values.to_numpy(), count.values.to_numpy()
        words = np.append(words_of(data)[0], len(data))
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], np.maximum.accumulate((begin + count)[order])
        apart = np.flatnonzero(begin[1:] > end[:-1])
        begin, end = begin[np.append(0, apart + 1)], end[np.append(apart, len(end) - 1)]
        edges = [0, *np.stack([words[begin], words[end]], axis=1).ravel().tolist(), len(data)]
        return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()

    return pa.array([cut(*row) for row in zip(texts, begins, counts, strict=True)], pa.string())


def without_repeated_passages(documents: DataFrame, least_words: int = 0, moved: bool = True) -> DataFrame:
    """``documents`` with the repeated passages cut out of ``text``; all other columns and names stay as they are.

    A document is its id and text: copies with equal ids are one document and keep what the first copy of the text keeps.
    Whatever is left of a text stays, a title of one word too, and a text of which nothing is left is empty; with ``least_words``
    what has lost a passage and has fewer words left is dropped.  Short and empty texts that lose nothing stay.  Without ``moved``
    blocks that cross the alignment of their pair stay.  See :func:`common_blocks` for which passages go.  No rows give no rows.
    """
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    keyed = plain.withColumn("document", F.xxhash64(text))
    # what is cut grows with the input, so it is never broadcast; texts are not sorted for it
    with small_batches(documents.sparkSession):
        found = common_blocks(documents)
    if not moved:
        found = found.withColumn("blocks", F.filter("blocks", lambda block: ~block["moved"]))
    found = found.select("document", "first_id", "copied", F.col("blocks.start").alias("starts"), F.col("blocks.words").alias("counts"))
    joined = keyed.join(found.hint("shuffle_hash"), "document", "left")
    # a copy is aligned whole with the first one; it has no line if it is short
    copy = F.col("copied") & (F.coalesce(F.col(doc_id).cast("bigint"), F.lit(2**63 - 1)) != F.col("first_id"))
    joined = joined.withColumn("whole", F.coalesce(copy, F.lit(False)) & _has_words(F.col(text), BLOCK_WORDS))
    whole = F.col("whole")
    lost = ~whole & F.coalesce(F.size("starts") > 0, F.lit(False))
    # only texts with blocks to cut are read in Python
    changed = cut_blocks(F.when(lost, F.col(text)), F.when(lost, F.col("starts")), F.when(lost, F.col("counts")))
    joined = joined.withColumn("cut", F.when(whole, F.lit("")).when(lost, changed).otherwise(F.col(text)))
    left = joined.where(~(whole | lost) | _has_words(F.col("cut"), least_words)) if least_words else joined
    columns = [F.col("cut") if f"c{i}" == text else F.col(f"c{i}") for i in range(len(names))]
    return left.select(*columns).toDF(*names)
