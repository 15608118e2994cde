"""Length filter and its report; plain predicates that Catalyst can move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_predicate(min_length: int | None, max_length: int | None, text_col: str = "text") -> Column:
    """Inclusive bounds in code points; 0 and None leave a side open."""
    length = F.char_length(text_col)
    keep = F.lit(True)
    if min_length:
        keep = keep & (length >= min_length)
    if max_length:
        keep = keep & (length <= max_length)
    return keep


def length_filter(
    df: DataFrame, min_length: int | None = None, max_length: int | None = None, text_col: str = "text"
) -> DataFrame:
    return df.where(length_predicate(min_length, max_length, text_col))


def filter_report(
    df: DataFrame,
    min_length: int | None = None,
    max_length: int | None = None,
    split_col: str = "split",
    text_col: str = "text",
) -> DataFrame:
    """Rows before and after the filter, per split, in one pass.  NULL and empty texts are counted too."""
    return df.groupBy(F.col(split_col).alias("split")).agg(
        F.count("*").alias("original"),
        F.count_if(length_predicate(min_length, max_length, text_col)).alias("kept"),
        (F.count("*") - F.count_if(length_predicate(min_length, max_length, text_col))).alias("removed"),
        F.count_if(F.col(text_col).isNull()).alias("null_texts"),
        F.count_if(F.col(text_col) == "").alias("empty_texts"),
    )
