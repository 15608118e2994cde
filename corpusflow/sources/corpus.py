"""Reading a configured corpus into ``(split, doc_id, text)``."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators.vocabulary import Vocabulary
from corpusflow.sources.config import READERS, CorpusConfig
from corpusflow.storage import materialize

ROWS_PER_FILE_BITS = 36
#: Up to so many short rows a list of files is broadcast.
MAX_BROADCAST_FILES = 1_000_000


def _files(path: str) -> list[tuple[str, str]]:
    """``(path as Spark reads it, path below the corpus folder)`` of every data file, in name order."""
    store, root = fs.FileSystem.from_uri(path)
    info = store.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, "")]
    listing = store.get_file_info(fs.FileSelector(root, recursive=True))
    inner = sorted(f.path[len(root) :].lstrip("/") for f in listing if f.type == fs.FileType.File)
    return [
        (f"{path.rstrip('/')}/{name}", name)
        for name in inner
        if not any(part.startswith(("_", ".")) for part in name.split("/"))
    ]


def _split_of(name: str, known: list[str]) -> str | None:
    """Split a file belongs to: its folder, or the head of its name (``train.parquet``, ``train-00001.json``)."""
    parts = name.split("/")
    if len(parts) > 1:
        head = parts[0].removeprefix("split=")
        if head in known:
            return head
    stem = parts[-1].split(".")[0]
    return next((split for split in known if re.fullmatch(re.escape(split) + r"([-_].*)?", stem)), None)


def _suffix(name: str) -> str | None:
    return next((s for s in READERS if name.endswith(s) or f"{s}." in name.rsplit("/", 1)[-1]), None)


def discover(config: CorpusConfig) -> dict[str, list[str]]:
    """Files of each physical split.  When no file names a split, all of them are ``train``.

    Files that name none beside files that do are an error, and so is a split of several formats.
    """
    files = [(full, name) for full, name in _files(config.path) if config.format or _suffix(full)]
    if not files:
        raise FileNotFoundError(f"no data files under {config.path}")
    known = [*config.splits.values(), "train", "validation", "test"]
    found: dict[str, list[str]] = {}
    unplaced = []
    for full, name in files:
        split = _split_of(name, known)
        found.setdefault(split, []).append(full) if split else unplaced.append(full)
    if found and unplaced:
        raise ValueError(f"{config.name}: files that belong to no split: {', '.join(unplaced[:10])}")
    found = found or {config.splits["train"]: unplaced}
    for split, paths in found.items():
        kinds = {config.format or READERS[_suffix(path)] for path in paths}
        if len(kinds) > 1:
            raise ValueError(f"{config.name}: split {split!r} mixes formats: {', '.join(sorted(kinds))}")
    return found


def _with_row_ids(df: DataFrame, first_file: int = 0) -> DataFrame:
    """Ids from file order and row position: stable however often a task is run, increasing as stored.

    Files are numbered from ``first_file`` on, so that splits numbered one after the other share no id.
    """

    def plain(path):
        return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")

    files = [(path, first_file + n) for n, path in enumerate(sorted(df.inputFiles()))]
    numbered = df.sparkSession.createDataFrame(files, "path STRING, file_no BIGINT")
    place = df.withColumn("file", plain(F.col("_metadata.file_path"))).withColumn("row", F.col("_metadata.row_index"))
    numbered = numbered.select(plain(F.col("path")).alias("file"), "file_no")
    matched = place.join(F.broadcast(numbered) if len(files) <= MAX_BROADCAST_FILES else numbered.hint("merge"), "file")
    return matched.withColumn("doc_id", F.shiftleft("file_no", ROWS_PER_FILE_BITS) + F.col("row"))


def _read_split(spark: SparkSession, config: CorpusConfig, split: str, files: list[str], first_file: int) -> tuple[DataFrame, int]:
    """The rows of a split, and the number for the first file of the next one."""
    kind = config.format or READERS[_suffix(files[0])]
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    if kind == "json":
        # the fields that are used and no others, as strings: types may differ from file to file, and no value is lost
        used = [name for name in (config.text_field, config.id_field) if name]
        if set(used) <= set(reader.load(files[0]).columns) or set(used) <= set(reader.load(files).columns):
            reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in dict.fromkeys(used)]))
    df = reader.load(files)
    field = "value" if kind == "text" and config.text_field not in df.columns else config.text_field
    if field not in df.columns:
        raise ValueError(f"{config.name}: no column {field!r} in {df.columns}")
    if config.id_field:
        number = F.col(config.id_field)
        if kind == "json":  # an id such as 12.0 is a number too; what is none is an error
            number = F.coalesce(number.try_cast("bigint"), number.cast("decimal(38,10)"))
        df = df.withColumn("doc_id", number.cast("bigint"))
    elif kind == "parquet":
        df, first_file = _with_row_ids(df, first_file), first_file + len(df.inputFiles())
    else:
        # only parquet rows have a position; write the texts once and number what was written
        written = materialize(df.select(F.col(field)), f"ingest-{split}")
        df, first_file = _with_row_ids(written, first_file), first_file + len(written.inputFiles())
    return df.select(F.lit(split).alias("split"), "doc_id", F.col(field).cast("string").alias("text")), first_file


def read_corpus(spark: SparkSession, config: CorpusConfig) -> DataFrame:
    """All splits of a corpus; the split is a column."""
    if config.source == "huggingface":
        raise ValueError("hub corpora are not fetched; download them and use source 'local'")
    if config.source != "local":
        raise ValueError(f"unknown source: {config.source}")
    frames, first_file = [], 0
    for split, files in sorted(discover(config).items()):
        frame, first_file = _read_split(spark, config, split, files, first_file)
        frames.append(frame)
    return reduce(DataFrame.unionByName, frames)


def resolve_splits(
    corpus: DataFrame, config: CorpusConfig, present: Iterable[str] | None = None
) -> tuple[DataFrame, bool]:
    """Map physical split names to ``train`` and ``validation``; other splits are left out.

    The flag says whether a validation split is both named and there.  ``present`` are the physical
    splits there are; by default they come from the file names, without a look at the rows.
    """
    train, validation = config.splits["train"], config.splits.get("validation")
    present = set(discover(config) if present is None else present)
    if train not in present:
        raise ValueError(f"{config.name}: no split {train!r}, found {sorted(present)}")
    existing = validation is not None and validation in present
    logical = F.when(F.col("split") == train, "train")
    if existing:
        logical = logical.when(F.col("split") == validation, "validation")
    return corpus.withColumn("split", logical).where(F.col("split").isNotNull()), existing


def write_tokenized(encoded: DataFrame, path: str) -> DataFrame:
    """Store encoded documents by split, so later readers prune to the split they need."""
    encoded.write.mode("overwrite").partitionBy("split").parquet(path)
    return encoded.sparkSession.read.schema(encoded.schema).parquet(path)


def write_metadata(metadata: DataFrame, path: str) -> None:
    """One JSON object."""
    metadata.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_vocabulary(vocab: Vocabulary, report: DataFrame, path: str) -> None:
    """The vocabulary table and, beside it, the training report."""
    vocab.save(report.sparkSession, f"{path}/vocabulary")
    report.coalesce(1).write.mode("overwrite").json(f"{path}/report")
