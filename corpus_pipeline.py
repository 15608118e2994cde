"""From raw documents to packed training sequences.

Each stage is a function of the session, the documents that the stage before kept, and the folder of the
tables.  ``run`` writes what a stage returns to the shared folder and reads it again for the next one, so a
lost executor costs no more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import staged
from corpusflow.llm.decontaminate import drop_contaminated
from corpusflow.llm.linedup import without_repeated_passages
from corpusflow.llm.packing import pack
from corpusflow.llm.queries import TOXIC, table, tokenizer_path
from corpusflow.llm.simhash import drop_near_duplicates
from corpusflow.llm.toxicity import drop_toxic, fit_toxicity

#: Of what has lost a passage, fewer words are the torn edge of one and no document.
LEAST_WORDS = 7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), TOXIC)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have; those that have lost some and are a few words now go."""
    left = without_repeated_passages(docs, LEAST_WORDS)
    names = [name.lower() for name in left.columns]
    if names.count("n_chars") == names.count("text") == 1:
        left = left.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return left


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by fingerprints and by shingles."""
    return drop_near_duplicates(docs, fingerprints=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their token ids."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier, the fingerprints and the tokenizer have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
