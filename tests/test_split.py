import hashlib
import math

import pytest

from corpusflow.operators.split import holdout_split


def expected(ids, fraction, seed):
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    return set(order[: math.ceil(fraction * len(ids))])


@pytest.mark.parametrize("n, fraction, seed", [(1000, 0.05, 42), (997, 0.01, 7), (3, 0.5, 1), (50_000, 0.123, 3)])
def test_exact_size_and_members(spark, n, fraction, seed):
    df = spark.range(n).withColumnRenamed("id", "doc_id")
    for partitions in (1, 3, 8):
        split = holdout_split(df.repartition(partitions), fraction, seed)
        held = {row.doc_id for row in split.where("split = 'validation'").collect()}
        assert held == expected(range(n), fraction, seed)
    assert split.count() == n and split.select("split").distinct().count() == 2


@pytest.mark.parametrize("fraction", [0, 1, -0.1, 1.5])
def test_fraction_must_be_inside(spark, fraction):
    with pytest.raises(ValueError):
        holdout_split(spark.range(5).withColumnRenamed("id", "doc_id"), fraction)


def test_nothing_left_to_train_on(spark):
    with pytest.raises(ValueError):
        holdout_split(spark.range(1).withColumnRenamed("id", "doc_id"), 0.5)


def test_equal_and_missing_ids(spark):
    df = spark.createDataFrame([(5,)] * 20, "doc_id BIGINT")
    with pytest.raises(ValueError, match="one id"):
        holdout_split(df, 0.2)
    with pytest.raises(ValueError, match="no doc_id"):
        holdout_split(spark.createDataFrame([(1,), (None,), (2,)], "doc_id BIGINT"), 0.3)


@pytest.mark.parametrize("small", [0, 1000])
def test_equal_ids_at_the_cut_are_parted(spark, monkeypatch, small):
    monkeypatch.setattr("corpusflow.operators.split.SORTED_ROWS", small)
    rows = [(7, f"text {i}") for i in range(300)] + [(i, "other") for i in range(20)] + [(7, "text 0"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    for fraction in (0.2, 0.5, 0.77):
        held = [holdout_split(df.repartition(n), fraction).where("split = 'validation'").collect() for n in (1, 5)]
        assert len(held[0]) == math.ceil(fraction * len(rows))
        assert sorted(map(repr, held[0])) == sorted(map(repr, held[1]))


def test_equal_ids_away_from_the_cut_stay_together(spark):
    ids = [*range(200), *([7] * 30)]
    order = sorted(ids, key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    size = next(n for n in range(60, 200) if order[n - 1] != order[n])
    df = spark.createDataFrame([(i,) for i in ids], "doc_id BIGINT")
    held = [row.doc_id for row in holdout_split(df, (size - 0.5) / len(ids)).where("split = 'validation'").collect()]
    assert sorted(held) == sorted(order[:size])


def test_cells_are_parted_until_they_are_small(spark, monkeypatch):
    monkeypatch.setattr("corpusflow.operators.split.SORTED_ROWS", 0)
    split = holdout_split(spark.range(500).withColumnRenamed("id", "doc_id"), 0.1, 3)
    assert {row.doc_id for row in split.where("split = 'validation'").collect()} == expected(range(500), 0.1, 3)
