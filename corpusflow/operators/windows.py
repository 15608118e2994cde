"""Fixed-length training windows cut from a token stream, their targets, masks and batches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.stream import TokenStream
from corpusflow.sources.config import check_window_arguments

#: Fixed value: the target that the loss ignores.
IGNORE_INDEX = -100


def window_count(n_tokens: int, block_size: int, stride: int) -> int:
    """Windows of ``block_size + 1`` tokens in a stream; the tail is dropped."""
    check_window_arguments(block_size, stride)
    if n_tokens < block_size + 1:
        raise ValueError(f"not enough tokens: {n_tokens} for block_size {block_size}")
    return (n_tokens - (block_size + 1)) // stride + 1


def window_counts(totals: dict[str, int], block_size: int, stride: int) -> dict[str, int]:
    return {split: window_count(n, block_size, stride) for split, n in totals.items()}


#: Windows whose pieces are cut from one row.
WINDOWS_PER_STRETCH = 64


def _in_stretches(segments: DataFrame, block_size: int, stride: int) -> DataFrame:
    """Segments cut into rows of at most ``WINDOWS_PER_STRETCH`` windows, each with the ids these windows cover.

    A row then yields a bounded number of pieces, however long the document and however small the stride.
    """
    end = F.col("offset") + F.col("token_len")

    def stretch(first: Column) -> Column:
        last = F.least(first + (WINDOWS_PER_STRETCH - 1), F.col("last_window"))
        start = F.greatest(F.col("offset"), first * stride)
        stop = F.least(end, last * stride + block_size + 1)
        ids = F.slice("ids", (start - F.col("offset") + 1).cast("int"), (stop - start).cast("int"))
        return F.struct(first.alias("first_window"), last.alias("last_window"), start.alias("offset"), (stop - start).alias("token_len"), ids.alias("ids"))

    firsts = F.sequence("first_window", "last_window", F.lit(WINDOWS_PER_STRETCH).cast("bigint"))
    own = ("first_window", "last_window", "offset", "token_len", "ids")
    # nearly all documents are short; these stay as they are
    whole = F.array(F.struct(*[F.col(c).cast("bigint").alias(c) if c == "token_len" else F.col(c) for c in own]))
    few = F.col("last_window") - F.col("first_window") < WINDOWS_PER_STRETCH
    others = [c for c in segments.columns if c not in own]
    return segments.select(*others, F.inline(F.when(few, whole).otherwise(F.transform(firsts, stretch))))


def _window_pieces(segments: DataFrame, block_size: int, stride: int, extra: list[str]) -> DataFrame:
    """One row per window a segment takes part in: ``window_id`` and the stream range ``[start, stop)``."""
    span = block_size + 1
    first = F.greatest(F.lit(0), F.expr(f"(offset - {block_size} + {stride - 1}) div {stride}"))
    last = F.least(
        F.expr(f"(split_tokens - {span}) div {stride}"), F.expr(f"(offset + token_len - 1) div {stride}")
    )
    end = F.col("offset") + F.col("token_len")

    def piece(w: Column) -> Column:
        start = F.greatest(F.col("offset"), w * stride)
        stop = F.least(end, w * stride + span)
        fields = [w.alias("window_id"), start.alias("start"), stop.alias("stop")]
        if "ids" in extra:
            ids = F.slice("ids", (start - F.col("offset") + 1).cast("int"), (stop - start).cast("int"))
            fields.append(ids.alias("piece"))
        return F.struct(*fields)

    kept = [name for name in extra if name != "ids"]
    taking_part = (
        segments.withColumn("first_window", first.cast("bigint")).withColumn("last_window", last.cast("bigint")).where("first_window <= last_window")
    )
    if "ids" in extra:
        taking_part = _in_stretches(taking_part, block_size, stride)
    return taking_part.select("split", *kept, F.inline(F.transform(F.sequence("first_window", "last_window"), piece)))


def _assemble(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Put the pieces of each window together; a group never holds more than ``block_size + 1`` tokens."""
    ordered = F.array_sort(F.collect_list(F.struct("start", "piece")))
    return (
        pieces.groupBy(*keys)
        .agg(ordered.alias("pieces"))
        .select("split", "window_id", F.flatten("pieces.piece").alias("tokens"))
    )


def pack_windows(
    stream: TokenStream,
    block_size: int,
    stride: int,
    eos_id: int | None = None,
    mask_splits: Iterable[str] = (),
    window_range: tuple[int, int] | None = None,
) -> DataFrame:
    """Windows ``(split, window_id, x, y)`` of every split; ``y`` is ``x`` one token later.

    Windows inside a bucket are put together where the bucket already is.  Only windows that cross a
    bucket border, at most a few per bucket, are shuffled again.  In ``mask_splits`` targets from the
    first EOS in ``x`` on are ignored.  ``window_range`` (inclusive) cuts those windows only.
    """
    counts = window_counts(stream.totals, block_size, stride)
    mask_splits = list(mask_splits)
    if mask_splits and eos_id is None:
        raise ValueError("masking needs an EOS id")
    span = block_size + 1
    segments = stream.segments
    if window_range is not None:
        low, high = window_range
        for split, count in counts.items():
            if low < 0 or high < low or high >= count:
                raise IndexError(f"windows {low}..{high} are not within 0..{count - 1} of {split!r}")
        segments = stream.between(dict.fromkeys(counts, (low * stride, high * stride + span))).where(
            (F.col("offset") < high * stride + span) & (F.col("offset") + F.col("token_len") > low * stride)
        )
    inside = (F.col("window_id") * stride >= F.col("bucket_start")) & (
        F.col("window_id") * stride + span <= F.col("bucket_end")
    )
    near_border = (F.col("offset") < F.col("bucket_start") + span) | (
        F.col("offset") + F.col("token_len") > F.col("bucket_end") - span
    )

    def pieces(of: DataFrame) -> DataFrame:
        cut = _window_pieces(of, block_size, stride, ["bucket", "bucket_start", "bucket_end", "ids"])
        return cut if window_range is None else cut.where(F.col("window_id").between(low, high))

    tokens = _assemble(pieces(segments).where(inside), ["split", "bucket", "window_id"]).unionByName(
        _assemble(pieces(segments.where(near_border)).where(~inside), ["split", "window_id"])
    )
    return shift_targets(tokens, block_size, eos_id, F.col("split").isin(mask_splits) if mask_splits else None)


def shift_targets(tokens: DataFrame, block_size: int, eos_id: int | None, masked: Column | None) -> DataFrame:
    """Split ``block_size + 1`` tokens into inputs and targets, and mask where asked."""
    df = tokens.withColumn("x", F.slice("tokens", 1, block_size)).withColumn("y", F.slice("tokens", 2, block_size))
    if masked is not None:
        eos_at = F.array_position("x", F.lit(eos_id)).cast("int")
        cut = F.concat(F.slice("y", F.lit(1), eos_at - 1), F.array_repeat(F.lit(IGNORE_INDEX), F.lit(block_size) - eos_at + 1))
        df = df.withColumn("y", F.when(masked & (eos_at > 0), cut).otherwise(F.col("y")))
    return df.select("split", "window_id", "x", "y")


def batch(windows: DataFrame, batch_size: int, counts: dict[str, int], drop_last_splits: Iterable[str] = ()) -> DataFrame:
    """Consecutive windows form a batch.  Ids are dense, so this is arithmetic and needs no shuffle.

    ``counts`` are windows per split; in ``drop_last_splits`` an incomplete last batch is dropped.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    df = windows.withColumn("batch_id", F.expr(f"window_id div {batch_size}")).withColumn(
        "row_in_batch", (F.col("window_id") % batch_size).cast("int")
    )
    for split in drop_last_splits:
        whole = counts[split] // batch_size
        df = df.where((F.col("split") != split) | (F.col("batch_id") < whole))
    return df
