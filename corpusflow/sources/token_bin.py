"""``token_bin``: packed little-endian token files as a Spark data source.

A token stream is one ``.bin`` file, or a folder of shards with a manifest.  Shards are written in
parallel under their final names and become visible when the manifest is written, so a task that runs
twice or dies leaves nothing a reader would see, and object stores need no rename.

A stream that keeps growing is a folder with one manifest an epoch: the sink of a streaming query adds an epoch's shards under its
number, once, however often the epoch is run, and a streaming read takes up what epochs have added since its last offset.

Reading is by token ranges (options ``first`` and ``stop``).  Filters are not pushed to the reader: Spark 4.1 keeps one reader
for all uses of a table, so what one query leaves out would be missing from the next.  With ``block_size`` and ``stride`` a row carries whole windows including
the tokens they share with the next row, so cutting windows from files needs no shuffle at all.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpusflow.operators.stream import TokenStream
from corpusflow.operators.windows import shift_targets, window_count
from corpusflow.sources.config import check_window_arguments

MANIFEST = "manifest.json"
EPOCH_NAME = re.compile(r"epoch-([0-9]{12})\.json")
#: Element types on disk and the Spark and Arrow types that hold them (Spark has no unsigned).
TYPES = {"uint16": ("<u2", "INT", pa.int32()), "uint32": ("<u4", "BIGINT", pa.int64())}
RANGE_TOKENS = 32 << 20
MAX_RANGES = 100_000
SHARD_NAME = re.compile(r"tokens-[0-9]{18}-[0-9a-f]{32}\.bin")
ROW_TOKENS = 1 << 16


@dataclass(frozen=True)
class Shard:
    path: str
    first: int
    count: int


def _element(dtype: str) -> tuple[str, str, pa.DataType]:
    if dtype not in TYPES:
        raise ValueError(f"dtype must be one of {sorted(TYPES)}, got {dtype!r}")
    return TYPES[dtype]


def list_shards(path: str, dtype: str) -> list[Shard]:
    """Shards of a stream in order.

    A folder of foreign ``.bin`` files is read by file name.  Shards of this source without a manifest were never
    committed and are an error.
    """
    width = np.dtype(_element(dtype)[0]).itemsize
    store, root = fs.FileSystem.from_uri(path)
    info = store.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        files = [info]
    else:
        if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}") as stream:
                manifest = json.loads(stream.read())
            if manifest["dtype"] != dtype:
                raise ValueError(f"{path} holds {manifest['dtype']}, not {dtype}")
            return [Shard(f"{root}/{s['shard']}", s["first_offset"], s["n_tokens"]) for s in manifest["shards"]]
        listing = store.get_file_info(fs.FileSelector(root))
        epochs = sorted(f.path for f in listing if EPOCH_NAME.fullmatch(f.base_name))
        if epochs:
            return [shard for epoch in epochs for shard in _epoch_shards(store, root, epoch, dtype)]
        files = sorted((f for f in listing if f.path.endswith(".bin")), key=lambda f: f.path)
        if any(SHARD_NAME.fullmatch(f.base_name) for f in files):
            raise ValueError(f"{path} has shards but no {MANIFEST}: its writing did not end")
    shards, first = [], 0
    for file in files:
        if file.size % width:
            raise ValueError(f"size {file.size} of {file.path} is no multiple of {width} ({dtype})")
        shards.append(Shard(file.path, first, file.size // width))
        first += file.size // width
    return shards


def _epoch_shards(store: fs.FileSystem, root: str, path: str, dtype: str) -> list[Shard]:
    with store.open_input_stream(path) as stream:
        manifest = json.loads(stream.read())
    if manifest["dtype"] != dtype:
        raise ValueError(f"{root} holds {manifest['dtype']}, not {dtype}")
    return [Shard(f"{root}/{s['shard']}", s["first_offset"], s["n_tokens"]) for s in manifest["shards"]]


def token_count(path: str, dtype: str) -> int:
    return sum(shard.count for shard in list_shards(path, dtype))


@dataclass
class TokenRange(InputPartition):
    """Rows ``first_row .. stop_row`` and the shards that hold their tokens."""

    first_row: int
    stop_row: int
    shards: list[Shard]


class TokenBinReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.dtype = options.get("dtype", "uint16")
        self.block_size = int(options.get("block_size", 0))
        self.stride = int(options.get("stride", 0))
        self.row_tokens = int(options.get("row_tokens", ROW_TOKENS))
        self.range_tokens = int(options.get("range_tokens", RANGE_TOKENS))
        self.min_tasks = int(options.get("min_tasks", 1))
        shards = list_shards(self.path, self.dtype)
        self.total = sum(shard.count for shard in shards)
        if self.block_size:
            self.windows = window_count(self.total, self.block_size, self.stride)
            self.row_windows = max(1, self.row_tokens // self.stride)
        # only the rows that overlap the wanted tokens or windows are planned and read
        per_row, there = (self.row_windows, self.windows) if self.block_size else (self.row_tokens, self.total)
        first, stop = int(options.get("first", 0)), min(int(options.get("stop", there)), there)
        self.wanted = range(first // per_row, max(first // per_row, -(-stop // per_row)))

    def row_count(self) -> int:
        if self.block_size:
            return -(-self.windows // self.row_windows)
        return -(-self.total // self.row_tokens)

    def row_range(self, row: int) -> tuple[int, int]:
        """Stream positions a row covers."""
        if self.block_size:
            last = min((row + 1) * self.row_windows, self.windows) - 1
            return row * self.row_windows * self.stride, last * self.stride + self.block_size + 1
        return row * self.row_tokens, min((row + 1) * self.row_tokens, self.total)

    def partitions(self) -> list[TokenRange]:
        shards = list_shards(self.path, self.dtype)
        step = self.row_windows * self.stride if self.block_size else self.row_tokens
        rows = len(self.wanted)
        per_task = max(1, min(self.range_tokens // step, -(-rows // self.min_tasks)), -(-rows // MAX_RANGES))
        ranges, at = [], 0
        for first in self.wanted[::per_task]:
            stop = min(first + per_task, self.wanted.stop)
            start, end = self.row_range(first)[0], self.row_range(stop - 1)[1]
            while shards[at].first + shards[at].count <= start:
                at += 1
            through = at
            while through < len(shards) and shards[through].first < end:
                through += 1
            ranges.append(TokenRange(first, stop, shards[at:through]))
        return ranges

    def read(self, partition: TokenRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty stream has no ranges
            return
        spans = (self.row_range(row) for row in range(partition.first_row, partition.stop_row))
        yield from _read_spans(self.path, self.dtype, spans, partition.shards)


def _read_spans(path: str, dtype: str, spans: Iterable[tuple[int, int]], shards: list[Shard]) -> Iterator[pa.RecordBatch]:
    """``pos, tokens`` of stretches of a stream."""
    disk, _, arrow = _element(dtype)
    width = np.dtype(disk).itemsize
    store, _ = fs.FileSystem.from_uri(path)
    files = [(shard, store.open_input_file(shard.path)) for shard in shards]
    try:
        for start, stop in spans:
            parts = []
            for shard, file in files:
                low, high = max(start, shard.first), min(stop, shard.first + shard.count)
                if low < high:
                    raw = file.read_at((high - low) * width, (low - shard.first) * width)
                    parts.append(np.frombuffer(raw, disk))
            tokens = pa.array(np.concatenate(parts), arrow)
            rows = pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), tokens)
            yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), rows], ["pos", "tokens"])
    finally:
        for _, file in files:
            file.close()


@dataclass
class ShardsWritten(WriterCommitMessage):
    shards: list[tuple[str, int, int]]


class TokenBinWriter(DataSourceArrowWriter):
    """Rows ``(offset, ids)``; a new shard starts wherever a row does not continue the one before."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path = options["path"]
        self.dtype = options.get("dtype", "uint16")
        _element(self.dtype)
        store, root = fs.FileSystem.from_uri(self.path)
        if not overwrite and store.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.NotFound:
            raise ValueError(f"{self.path} holds a token stream already; use mode('overwrite')")
        store.create_dir(root)

    def write(self, batches: Iterator[pa.RecordBatch]) -> ShardsWritten:
        disk = np.dtype(_element(self.dtype)[0])
        store, root = fs.FileSystem.from_uri(self.path)
        shards: list[tuple[str, int, int]] = []
        out, name, first, at = None, "", 0, -1

        def close() -> None:
            if out is not None:
                out.close()
                shards.append((name, first, at - first))

        for batch in batches:
            offsets = batch.column("offset").to_numpy(zero_copy_only=False)
            arrays = batch.column("ids")
            values = arrays.flatten().to_numpy(zero_copy_only=False)
            if len(values) and (values.min() < 0 or values.max() > np.iinfo(disk).max):
                raise ValueError(f"token ids do not fit {self.dtype}")
            values = values.astype(disk)
            stops = np.cumsum(arrays.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            starts = np.concatenate(([0], stops[:-1]))
            follows = np.concatenate(([at], offsets[:-1] + stops[:-1] - starts[:-1]))
            breaks = np.flatnonzero(offsets != follows)
            runs = np.unique(np.concatenate(([0], breaks, [len(offsets)])))
            for begin, end in zip(runs[:-1], runs[1:]):
                if offsets[begin] != at:
                    close()
                    first = at = int(offsets[begin])
                    name = f"tokens-{first:018d}-{uuid.uuid4().hex}.bin"
                    out = store.open_output_stream(f"{root}/{name}")
                out.write(values[starts[begin] : stops[end - 1]].tobytes())
                at += int(stops[end - 1] - starts[begin])
        close()
        return ShardsWritten(shards)

    def commit(self, messages: list[ShardsWritten | None]) -> None:
        shards = sorted((shard for m in messages if m for shard in m.shards), key=lambda s: s[1:])
        shards = [shard for shard in shards if shard[2]]
        at = 0
        for name, first, count in shards:
            if first != at:
                raise ValueError(f"shard {name} starts at {first}, expected {at}: the stream has a gap or an overlap")
            at += count
        manifest = {
            "dtype": self.dtype,
            "n_tokens": at,
            "shards": [{"shard": n, "first_offset": f, "n_tokens": c} for n, f, c in shards],
        }
        store, root = fs.FileSystem.from_uri(self.path)
        with store.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(manifest).encode())
        # shards of an earlier stream or of attempts that did not count
        keep = {name for name, _, _ in shards} | {MANIFEST}
        for file in store.get_file_info(fs.FileSelector(root)):
            if file.base_name not in keep and file.base_name.startswith("tokens-"):
                store.delete_file(file.path)

    def abort(self, messages: list[ShardsWritten | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for name, _, _ in message.shards if message else []:
                store.delete_file(f"{root}/{name}")


@dataclass
class StreamRange(InputPartition):
    """Stretches that became whole since the last offset, and the shards that hold them."""

    spans: list[tuple[int, int]]
    shards: list[Shard]


class TokenBinStreamReader(DataSourceStreamReader):
    """What epochs add to a stream: its tokens, or with ``block_size`` the windows that became whole, each once.

    An offset is the number of tokens that the committed epochs hold, which never falls, so an offset in a checkpoint stays good.
    """

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.dtype = options.get("dtype", "uint16")
        self.block_size = int(options.get("block_size", 0))
        self.stride = int(options.get("stride", self.block_size))
        self.row_tokens = int(options.get("row_tokens", ROW_TOKENS))
        self.range_tokens = int(options.get("range_tokens", RANGE_TOKENS))

    def initialOffset(self) -> dict:
        return {"tokens": 0}

    def latestOffset(self) -> dict:
        store, root = fs.FileSystem.from_uri(self.path)
        there = store.get_file_info(root).type == fs.FileType.Directory
        epochs = _epochs(store, root) if there else {}
        return {"tokens": _end(store, root, epochs[max(epochs)]) if epochs else 0}

    def _windows(self, tokens: int) -> int:
        return (tokens - self.block_size - 1) // self.stride + 1 if tokens > self.block_size else 0

    def partitions(self, start: dict, end: dict) -> list[StreamRange]:
        low, high = start["tokens"], end["tokens"]
        if self.block_size:
            per_row = max(1, self.row_tokens // self.stride)
            first, stop = self._windows(low), self._windows(high)
            rows = [(w, min(w + per_row, stop)) for w in range(first, stop, per_row)]
            spans = [(a * self.stride, (b - 1) * self.stride + self.block_size + 1) for a, b in rows]
        else:
            spans = [(at, min(at + self.row_tokens, high)) for at in range(low, high, self.row_tokens)]
        shards, ranges, at = list_shards(self.path, self.dtype) if spans else [], [], 0
        per_task = max(1, self.range_tokens // self.row_tokens)
        for i in range(0, len(spans), per_task):
            part = spans[i : i + per_task]
            while shards[at].first + shards[at].count <= part[0][0]:
                at += 1
            ranges.append(StreamRange(part, [s for s in shards[at:] if s.first < part[-1][1]]))
        return ranges

    def read(self, partition: StreamRange) -> Iterator[pa.RecordBatch]:
        yield from _read_spans(self.path, self.dtype, partition.spans, partition.shards)


def _epochs(store: fs.FileSystem, root: str) -> dict[int, str]:
    found = ((EPOCH_NAME.fullmatch(f.base_name), f.path) for f in store.get_file_info(fs.FileSelector(root)))
    return {int(match[1]): path for match, path in found if match}


def _end(store: fs.FileSystem, root: str, manifest: str) -> int:
    with store.open_input_stream(manifest) as stream:
        return json.loads(stream.read())["end_offset"]


@dataclass
class EpochShard(WriterCommitMessage):
    task: int
    shard: str
    count: int


class TokenBinStreamWriter(DataSourceStreamArrowWriter):
    """Appends the ``ids`` of arriving rows, in the order of tasks and rows.

    An epoch's manifest is written under its number and moved into place.  If it is there already, the epoch has been
    committed before, and what the repeated run wrote is deleted.
    """

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.dtype = options.get("dtype", "uint16")
        _element(self.dtype)
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root)

    def write(self, batches: Iterator[pa.RecordBatch]) -> EpochShard:
        disk = np.dtype(_element(self.dtype)[0])
        store, root = fs.FileSystem.from_uri(self.path)
        task = TaskContext.get().partitionId()
        name, count, out = f"tokens-{task:018d}-{uuid.uuid4().hex}.bin", 0, None
        for batch in batches:
            values = batch.column("ids").flatten().to_numpy(zero_copy_only=False)
            if len(values) and (values.min() < 0 or values.max() > np.iinfo(disk).max):
                raise ValueError(f"token ids do not fit {self.dtype}")
            if len(values):
                out = out or store.open_output_stream(f"{root}/{name}")
                out.write(values.astype(disk).tobytes())
                count += len(values)
        if out is not None:
            out.close()
        return EpochShard(task, name, count)

    def commit(self, messages: list[EpochShard | None], batchId: int) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        epochs = _epochs(store, root)
        if batchId in epochs:
            self._delete(store, root, messages)
            return
        at = _end(store, root, epochs[max(epochs)]) if epochs else 0
        shards = []
        for message in sorted((m for m in messages if m and m.count), key=lambda m: m.task):
            shards.append({"shard": message.shard, "first_offset": at, "n_tokens": message.count})
            at += message.count
        target = f"{root}/epoch-{batchId:012d}.json"
        with store.open_output_stream(f"{target}.tmp") as out:
            out.write(json.dumps({"dtype": self.dtype, "end_offset": at, "shards": shards}).encode())
        store.move(f"{target}.tmp", target)

    def abort(self, messages: list[EpochShard | None], batchId: int) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        self._delete(store, root, messages)

    @staticmethod
    def _delete(store: fs.FileSystem, root: str, messages: list[EpochShard | None]) -> None:
        for message in messages:
            if message and message.count:
                store.delete_file(f"{root}/{message.shard}")


class TokenBinSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "token_bin"

    def schema(self) -> str:
        return f"pos BIGINT, tokens ARRAY<{_element(self.options.get('dtype', 'uint16'))[1]}>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return TokenBinReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return TokenBinWriter(dict(self.options), overwrite)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TokenBinStreamReader(dict(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return TokenBinStreamWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenBinSource)


def read_tokens(spark: SparkSession, path: str, dtype: str = "uint16", **options: object) -> DataFrame:
    """``(pos, tokens)``: consecutive stretches of the stream."""
    register(spark)
    options = {"min_tasks": spark.sparkContext.defaultParallelism, **options}
    return spark.read.format("token_bin").options(dtype=dtype, **options).load(path)


def write_tokens(segments: DataFrame, path: str, dtype: str = "uint16") -> None:
    """Write ``(offset, ids)`` rows as a sharded stream.

    Rows should be sorted by offset within their partitions, as token streams are; then there is one
    shard per bucket and nothing is shuffled.  In any other order the result is the same stream in more
    shards.
    """
    register(segments.sparkSession)
    segments.select("offset", "ids").write.format("token_bin").mode("overwrite").option("dtype", dtype).save(path)


def write_stream(stream: TokenStream, path: str, dtype: str = "uint16") -> None:
    """One sharded stream per split under ``path/<split>``."""
    for split in stream.totals:
        write_tokens(stream.segments.where(F.col("split") == split), f"{path}/{split}", dtype)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, first_offset, n_tokens)`` of a stream."""
    manifest = spark.read.option("multiLine", True).json(f"{path}/{MANIFEST}")
    return manifest.select(F.inline("shards")).select("shard", "first_offset", "n_tokens")


def read_windows(
    spark: SparkSession,
    path: str,
    block_size: int,
    stride: int,
    dtype: str = "uint16",
    split: str = "train",
    eos_id: int | None = None,
    mask_after_eos: bool = False,
    window_range: tuple[int, int] | None = None,
    **options: object,
) -> DataFrame:
    """Windows ``(split, window_id, x, y)`` of a token file, cut where they are read.

    ``window_range`` (inclusive) reads those windows only: no other part of the files is looked at.
    """
    if mask_after_eos and eos_id is None:
        raise ValueError("masking needs an EOS id")
    count = window_count(token_count(path, dtype), block_size, stride)
    if window_range is not None:
        low, high = window_range
        if low < 0 or high < low or high >= count:
            raise IndexError(f"windows {low}..{high} are not within 0..{count - 1} of {split!r}")
        options = {**options, "first": low, "stop": high + 1}
    rows = read_tokens(spark, path, dtype, block_size=block_size, stride=stride, **options)
    windows = _cut(rows, block_size, stride, split)
    if window_range is not None:
        windows = windows.where(F.col("window_id").between(*window_range))
    return shift_targets(windows, block_size, eos_id, F.lit(True) if mask_after_eos else None)


def _cut(rows: DataFrame, block_size: int, stride: int, split: str) -> DataFrame:
    """``split, window_id, tokens`` of rows that carry whole windows."""
    span = block_size + 1

    def window(i: Column) -> Column:
        cut = F.slice("tokens", (i * stride + 1).cast("int"), F.lit(span))
        return F.struct((F.expr(f"pos div {stride}") + i).alias("window_id"), cut.alias("tokens"))

    ids = F.sequence(F.lit(0), F.expr(f"(size(tokens) - {span}) div {stride}"))
    return rows.select(F.lit(split).alias("split"), F.inline(F.transform(ids, window)))


def append_tokens(encoded: DataFrame, path: str, checkpoint: str, dtype: str = "uint16") -> StreamingQuery:
    """Append the ``ids`` of an arriving table to a stream of tokens, each micro-batch as one epoch, once."""
    register(encoded.sparkSession)
    return (
        encoded.select("ids").writeStream.format("token_bin").option("dtype", dtype).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def arriving_windows(
    spark: SparkSession,
    path: str,
    block_size: int,
    stride: int,
    dtype: str = "uint16",
    split: str = "train",
    eos_id: int | None = None,
    mask_after_eos: bool = False,
    **options: object,
) -> DataFrame:
    """Windows of a growing stream as a streaming table: each comes once, when its last token has come."""
    check_window_arguments(block_size, stride)
    if mask_after_eos and eos_id is None:
        raise ValueError("masking needs an EOS id")
    register(spark)
    rows = spark.readStream.format("token_bin").options(dtype=dtype, block_size=block_size, stride=stride, **options).load(path)
    return shift_targets(_cut(rows, block_size, stride, split), block_size, eos_id, F.lit(True) if mask_after_eos else None)


def copy_prefix(spark: SparkSession, source: str, target: str, n_tokens: int, dtype: str = "uint16") -> None:
    """The first ``n_tokens`` of a stream as a stream of its own; all of it when it is shorter.

    Only the part of the source that holds them is read.
    """
    if n_tokens < 0:
        raise ValueError("a token limit must not be negative")
    rows = read_tokens(spark, source, dtype, stop=n_tokens)
    keep = F.least(F.size("tokens").cast("bigint"), F.lit(n_tokens) - F.col("pos")).cast("int")
    write_tokens(rows.select(F.col("pos").alias("offset"), F.slice("tokens", F.lit(1), keep).alias("ids")), target, dtype)
