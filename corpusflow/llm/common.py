"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.storage import configured, scratch_path

#: Rows whose crc32(doc_id as text) leaves this remainder modulo 4 are held out from all training.
HELD_OUT_REMAINDER = 2

#: Texts that go to Python at once: a batch is there several times, in the JVM and in the worker.
TEXTS_AT_ONCE = 2000
SHUFFLE_CLEANUP, BATCH_ROWS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone.

    Columns are found by their exact name and place, so further columns, even ones that differ only in
    case or repeat a name, do not make a reference ambiguous; of repeated names the first counts.
    """
    have = df.columns
    missing = [name for name in names if name not in have]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {have}")
    places = [have.index(name) for name in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    return plain.select(*[F.col(f"c{place}").alias(name) for place, name in zip(places, names, strict=True)])


def rest(df: DataFrame, *taken: str, need: tuple[str, ...] = ()) -> list[str]:
    """Exact names of the columns that clash with none of ``taken``, whatever their case, first of each; ``need`` stays."""
    seen, names = {name.lower() for name in taken} - {name.lower() for name in need}, []
    for name in df.columns:
        if name in need and name not in names:
            names.append(name)
        elif name.lower() not in seen | {n.lower() for n in need}:
            names.append(name)
        seen.add(name.lower())
    return names


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut and rows stay as they are."""
    return staged_at(df, label)[0]


def staged_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As :func:`staged`, with the path, for tables that are dropped after use.

    The files of the shuffles that it took are deleted when it is written, not when the driver collects its garbage.
    """
    path = scratch_path(df.sparkSession, label)
    with configured(df.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """At most ``TEXTS_AT_ONCE`` rows in a batch that goes to Python, in what is run inside."""
    rows = int(spark.conf.get(BATCH_ROWS))
    with configured(spark, {BATCH_ROWS: str(min(rows, TEXTS_AT_ONCE) if rows > 0 else TEXTS_AT_ONCE)}):
        yield


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training; a null id is never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT_REMAINDER, F.lit(True))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, where null equals null."""
    other = right.withColumnsRenamed({key: f"other_{key}" for key in keys})
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"other_{key}")) for key in keys])
    return left.join(other, same, how).drop(*[f"other_{key}" for key in keys])


def with_key(documents: DataFrame) -> DataFrame:
    """Columns by place (``c0``, ``c1``, ...) with ``doc_id`` and ``text_key``, which tell documents apart."""
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.withColumns({"doc_id": F.col(f"c{names.index('doc_id')}"), "text_key": F.xxhash64(f"c{names.index('text')}")})


def without_documents(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """``documents``, all columns and names as they are, less those with the given ``doc_id, text_key``."""
    left = null_safe_join(with_key(documents), keys.select("doc_id", "text_key"), ["doc_id", "text_key"], "left_anti")
    return left.select(*[f"c{i}" for i in range(len(documents.columns))]).toDF(*documents.columns)


def one_of_each(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of ``documents`` for each of the given ``doc_id, text_key``."""
    some = null_safe_join(with_key(documents), keys.select("doc_id", "text_key"), ["doc_id", "text_key"], "left_semi")
    some = some.dropDuplicates(["doc_id", "text_key"])
    return some.select(*[f"c{i}" for i in range(len(documents.columns))]).toDF(*documents.columns)
