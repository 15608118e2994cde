"""Written intermediate tables.

A step whose result is read more than once is written as parquet into the shared folder named by
``spark.checkpoint.dir`` and read back.  That cuts lineage, survives the loss of executors, and lets
later steps read only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def workspace(spark: SparkSession) -> str:
    """Shared folder for intermediate tables; a local folder is made up only for local masters."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="corpusflow-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the workspace."""
    return f"{workspace(spark)}/corpusflow/{label}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as parquet and return the table read back together with its path."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str) -> DataFrame:
    return write_table(df, label)[0]


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`write_table` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def spread_small(df: DataFrame, bytes_per_core: int = 16 << 20) -> DataFrame:
    """Spread a small input over all cores.

    Tokenizing costs far more than moving the text, and a small file is often a single row group, hence
    a single task.  Inputs above ``bytes_per_core`` for each core have splits enough and stay where
    they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * bytes_per_core else df


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for what is run inside, and those of before afterwards."""
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def small_shuffles(spark: SparkSession) -> Iterator[None]:
    """At most one shuffle partition per core, for loops of many jobs over small tables."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, min(int(before), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(setting, before)
