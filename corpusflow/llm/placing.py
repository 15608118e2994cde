"""Places of rows in one order over all of them, and running sums along it, without a window over all rows.

Rows are dealt to ranges of the order and sorted there.  Each range counts its own rows, and what all ranges before it
hold is added afterwards; the driver sees one short row a range, never a row of the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import staged_at


def placed(rows: DataFrame, order: list[Column], sums: tuple[str, ...] = (), label: str = "placed") -> tuple[DataFrame, str]:
    """``rows`` with ``place``, from 0 without gaps, and ``<name>_before`` for each of the BIGINT columns ``sums``; and the table's path.

    Rows that ``order`` holds for equal come in any order, so it should end with all columns that matter.  A null counts
    0 in the sums.  No rows give no rows.
    """
    spark = rows.sparkSession
    names = ["local_place", *[f"{name}_local" for name in sums]]
    fields = [T.StructField("range", T.IntegerType()), *[T.StructField(name, T.LongType()) for name in names]]
    schema = T.StructType([*rows.schema.fields, *fields])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, before = 0, np.zeros(len(sums), np.int64)
        number = TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            columns = [pa.array(np.full(n, number, np.int32)), pa.array(np.arange(at, at + n))]
            for i, name in enumerate(sums):
                values = batch.column(name).fill_null(0).to_numpy()
                through = np.cumsum(values) + before[i]
                columns.append(pa.array(through - values))
                before[i] = through[-1] if n else before[i]
            at += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "range", *names])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    table, path = staged_at(dealt.mapInArrow(numbered, schema), label)
    totals = table.groupBy("range").agg(F.count("*").alias("n"), *[F.sum(name).alias(name) for name in sums])
    bases, before = [], [0] * (1 + len(sums))
    for row in sorted(totals.collect(), key=lambda row: row["range"]):
        bases.append((row["range"], *before))
        before = [a + (b or 0) for a, b in zip(before, row[1:], strict=True)]
    base_names = ["base_place", *[f"{name}_base" for name in sums]]
    bases = spark.createDataFrame(bases, T.StructType([fields[0], *[T.StructField(name, T.LongType()) for name in base_names]]))
    # one short row a range of the shuffle
    whole = table.join(F.broadcast(bases), "range")
    found = [(F.col("local_place") + F.col("base_place")).alias("place")]
    found += [(F.col(f"{name}_local") + F.col(f"{name}_base")).alias(f"{name}_before") for name in sums]
    return whole.select(*rows.columns, *found), path
