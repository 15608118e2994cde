"""Text to token ids and back.

Chunks are cut in the JVM by the same expression that feeds vocabulary learning.  Python sees only
chunk arrays, as Arrow batches: a batch is dictionary-encoded, each distinct chunk is merged once, and
the ids are gathered with numpy, a few rows at a time, so that a task holds little besides the batch that came.  The
operator is narrow; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.pretokenize import pretokenize
from corpusflow.operators.vocabulary import Vocabulary

LONG_CHUNK_BYTES = 64
NO_RANK = np.int64(1) << 62
#: Bytes of distinct chunks that are merged, and chunks whose ids are gathered, at once.
BYTES_AT_ONCE, CHUNKS_AT_ONCE = 1 << 20, 1 << 17


class PairTable(NamedTuple):
    """Every pair of ids whose joined bytes are a token: sorted ``left * n + right`` and that token.

    It has at most one entry per inner byte position of the vocabulary, so it may be broadcast.
    """

    n: int
    keys: np.ndarray
    ranks: np.ndarray

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NO_RANK)
        wanted = left * self.n + right
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.ranks[place], NO_RANK)


def pair_table(vocab: Vocabulary) -> PairTable:
    n, ranks = len(vocab.tokens), vocab.ranks
    rows = sorted(
        (ranks[token[:cut]] * n + ranks[token[cut:]], rank)
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    )
    table = np.array(rows, np.int64).reshape(-1, 2)
    return PairTable(n, table[:, 0].copy(), table[:, 1].copy())


def merge_chunks(data: np.ndarray, sizes: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many chunks at once, given their bytes end to end and their sizes.

    In every round each unfinished chunk joins its adjacent pair of lowest rank, leftmost first, so
    there are as many rounds as the busiest chunk has merges.
    """
    ids, owner = data.astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    if not len(ids):
        return ids.astype(np.int32), sizes

    def rank_after(places: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each place; none at the end of a chunk."""
        following = np.minimum(places + 1, len(ids) - 1)
        inside = (places < len(ids) - 1) & (owner[places] == owner[following])
        return np.where(inside, table.lookup(ids[places], ids[following]), NO_RANK)

    rank = rank_after(np.arange(len(ids)))
    done_ids, done_owner = [], []
    while len(ids):
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        length = np.diff(np.append(first, len(ids)))
        lowest = np.minimum.reduceat(rank, first)
        finished = np.repeat(lowest == NO_RANK, length)
        if finished.any():
            done_ids.append(ids[finished])
            done_owner.append(owner[finished])
            ids, owner, rank = ids[~finished], owner[~finished], rank[~finished]
            first, length, lowest = None, length[lowest != NO_RANK], lowest[lowest != NO_RANK]
            if not len(ids):
                break
            first = np.cumsum(length) - length
        hits = np.flatnonzero(rank == np.repeat(lowest, length))
        # leftmost hit of each chunk
        hits = hits[np.concatenate(([True], owner[hits[1:]] != owner[hits[:-1]]))]
        ids[hits] = rank[hits]
        keep = np.ones(len(ids), bool)
        keep[hits + 1] = False
        ids, owner, rank = ids[keep], owner[keep], rank[keep]
        hits = hits - np.arange(len(hits))
        rank[hits] = rank_after(hits)
        before = hits[hits > 0] - 1
        rank[before] = rank_after(before)
    ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return ids[order].astype(np.int32), np.bincount(owner, minlength=len(sizes))


def merge_long_chunk(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long chunk by the same rule, with a queue of candidate pairs: n log n."""
    size = len(piece)
    end = list(range(1, size + 1))  # end[i]: where the token starting at i ends, 0 when i starts none
    start = list(range(-1, size))  # start[e]: where the token ending at e starts
    queue = [(ranks[pair], i, i + 2) for i in range(size - 1) if (pair := piece[i : i + 2]) in ranks]
    heapify(queue)
    while queue:
        _, left, stop = heappop(queue)
        middle = end[left]
        if not middle or middle >= stop or end[middle] != stop:
            continue  # one of the two tokens has been joined with something else
        end[left], end[middle], start[stop] = stop, 0, left
        if left and (pair := piece[start[left] : stop]) in ranks:
            heappush(queue, (ranks[pair], start[left], stop))
        if stop < size and (pair := piece[left : end[stop]]) in ranks:
            heappush(queue, (ranks[pair], left, end[stop]))
    ids, at = [], 0
    while at < size:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


def encode_distinct(chunks: pa.Array, table: PairTable, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all given chunks end to end, and how many each chunk has."""
    chunks = chunks.cast(pa.large_binary())
    sizes = pc.binary_length(chunks).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // BYTES_AT_ONCE)) + 1
    spans = zip([0, *cuts], [*cuts, len(sizes)])
    parts = [_encode_some(chunks.slice(a, b - a), sizes[a:b], table, ranks) for a, b in spans]
    return np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])


def _encode_some(chunks: pa.Array, sizes: np.ndarray, table: PairTable, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    long = np.flatnonzero(sizes > LONG_CHUNK_BYTES)
    short = chunks.filter(pa.array(sizes <= LONG_CHUNK_BYTES)) if len(long) else chunks
    data = np.frombuffer(b"".join(short.to_pylist()), np.uint8)
    ids, counts = merge_chunks(data, np.where(sizes > LONG_CHUNK_BYTES, 0, sizes), table)
    if not len(long):
        return ids, counts
    # put the long chunks back in their places
    extra = [np.array(merge_long_chunk(chunks[int(i)].as_py(), ranks), np.int32) for i in long]
    places = (np.cumsum(counts) - counts)[long]
    pieces, at = [], 0
    for place, more in zip(places, extra):
        pieces += [ids[at:place], more]
        at = place
    counts = counts.copy()
    counts[long] = [len(more) for more in extra]
    return np.concatenate([*pieces, ids[at:]]), counts


def encode_slices(chunks: pa.ListArray, table: PairTable, ranks: dict[bytes, int]) -> Iterator[pa.ListArray]:
    """Ids of every row, some rows at a time: merge each distinct chunk of the batch once, then gather."""
    distinct = chunks.flatten().dictionary_encode()
    pool, sizes = encode_distinct(distinct.dictionary, table, ranks)
    firsts = np.cumsum(sizes) - sizes
    which = distinct.indices.to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(chunks), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    row = begin = 0
    while row < len(chunks):
        # a row of its own if it has more chunks than that
        stop = max(row + 1, int(np.searchsorted(ends, begin + CHUNKS_AT_ONCE, "right")))
        mine = which[begin : ends[stop - 1]]
        stops = np.concatenate(([0], np.cumsum(sizes[mine])))
        ids = np.empty(stops[-1], np.int32)
        for at in range(0, len(mine), CHUNKS_AT_ONCE):
            some = mine[at : at + CHUNKS_AT_ONCE]
            low, high = stops[at], stops[at + len(some)]
            shift = np.repeat(firsts[some] - stops[at : at + len(some)], sizes[some])
            ids[low:high] = pool[shift + np.arange(low, high)]
        offsets = stops[np.concatenate(([0], ends[row:stop] - begin))].astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=chunks.slice(row, stop - row).is_null())
        row, begin = stop, ends[stop - 1]


def encode_batch(chunks: pa.ListArray, table: PairTable, ranks: dict[bytes, int]) -> pa.ListArray:
    """Ids of every row of a batch."""
    return pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *encode_slices(chunks, table, ranks)])


def encode_ids(vocab: Vocabulary, text: Column | str, spark) -> Column:
    """Ids of a text without BOS and EOS.  Special-token names in the text are ordinary text."""
    # plain arrays and a dict, bounded by the vocabulary size
    shared = spark.sparkContext.broadcast((tuple(pair_table(vocab)), vocab.ranks))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def chunk_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, ranks = shared.value
        for chunks in batches:
            yield from encode_slices(chunks, PairTable(*table), ranks)

    return chunk_ids(pretokenize(text))


def drop_empty(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Keep rows whose text is not the empty string; NULL goes too."""
    return df.where(F.col(text_col) != "")


def encode(df: DataFrame, vocab: Vocabulary, text_col: str = "text") -> DataFrame:
    """``[BOS] + ids + [EOS]`` per document with its length in characters and in tokens."""
    ids = encode_ids(vocab, text_col, df.sparkSession)
    return (
        drop_empty(df, text_col)
        .withColumn("ids", ids)
        .withColumn("char_len", F.char_length(text_col))
        .withColumn("ids", F.concat(F.array(F.lit(vocab.bos_id)), "ids", F.array(F.lit(vocab.eos_id))))
        .withColumn("token_len", F.size("ids"))
        .drop(text_col)
    )


def decode_ids(vocab: Vocabulary, ids: Column | str) -> Column:
    """Text of an id array, in the JVM; byte sequences that are not UTF-8 become U+FFFD.

    The vocabulary is one folded array literal, looked up by position.  Ids that it does not have, negative
    ones among them, and NULL ids raise in every session mode.
    """
    ids = F.col(ids) if isinstance(ids, str) else ids
    tokens = vocab.all_bytes()
    table = F.split(F.lit(",".join(token.hex() for token in tokens)), ",")

    def token(i: Column) -> Column:
        known = F.coalesce((i >= 0) & (i < len(tokens)), F.lit(False))
        unknown = F.raise_error(F.concat(F.lit("no token has the id "), F.coalesce(i.cast("string"), F.lit("NULL"))))
        return F.when(known, F.get(table, i)).otherwise(unknown.cast("string"))

    hexed = F.array_join(F.transform(ids, token), "")
    return F.make_valid_utf8(F.unhex(hexed).cast("string")).alias("text")


def decode(df: DataFrame, vocab: Vocabulary, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    return df.withColumn(text_col, decode_ids(vocab, ids_col))


def strip_special(ids: Column | str) -> Column:
    """Drop the leading BOS and the trailing EOS."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.slice(ids, 2, F.size(ids) - 2)


def roundtrip_report(df: DataFrame, vocab: Vocabulary, text_col: str = "text") -> DataFrame:
    """How many non-empty texts there are and how many differ after encoding and decoding."""
    kept = drop_empty(df, text_col)
    decoded = decode_ids(vocab, encode_ids(vocab, text_col, df.sparkSession))
    return kept.select(F.col(text_col), decoded.alias("decoded")).agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("decoded") != F.col(text_col)).alias("mismatches"),
    )


def prepare_prompts(
    df: DataFrame, vocab: Vocabulary, context_length: int, add_bos: bool = True, text_col: str = "text"
) -> DataFrame:
    """Optional BOS, the ids of the prompt, and of those only the last ``context_length``."""
    if context_length <= 0:
        raise ValueError("context_length must be positive")
    ids = encode_ids(vocab, text_col, df.sparkSession)
    df = df.withColumn("ids", ids)
    if add_bos:
        df = df.withColumn("ids", F.concat(F.array(F.lit(vocab.bos_id)), "ids"))
    first = F.greatest(F.lit(1), F.size("ids") - context_length + 1)
    return df.withColumn("ids", F.slice("ids", first, F.lit(context_length))).drop(text_col)


def cut_at_eos(ids: Column | str, eos_id: int, max_new_tokens: int) -> Column:
    """Generated ids up to and including the first EOS, at most ``max_new_tokens``."""
    if max_new_tokens < 0:
        raise ValueError("max_new_tokens must not be negative")
    ids = F.col(ids) if isinstance(ids, str) else ids
    ids = F.slice(ids, 1, max_new_tokens)
    stop = F.coalesce(F.nullif(F.array_position(ids, eos_id), F.lit(0).cast("bigint")), F.size(ids))
    return F.slice(ids, 1, stop.cast("int"))
