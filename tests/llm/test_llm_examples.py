"""Trees for personal data learn from all spans, however many there are."""

from pyspark.sql import functions as F

from corpusflow.llm import pii


def test_all_examples_count(spark):
    n = 30_000
    examples = spark.range(n).select(
        F.col("id").alias("text_key"), F.lit("phone").alias("kind"), F.col("id").alias("start"),
        (F.col("id") % 3 == 0).cast("double").alias("label"), (F.col("id") % 3).cast("double").alias("f_a"), F.lit(1.0).alias("f_b"),
    )
    counted = pii._counted(examples, ["f_a", "f_b"])
    assert counted.count() == 6
    got = {(r["seen"], r["f_a"]): r["weight"] for r in counted.collect()}
    assert sum(got.values()) == n
    model, threshold = pii._fit(examples, ["f_a", "f_b"])
    assert 0.5 < threshold <= 1
    assert model.numFeatures == 2
