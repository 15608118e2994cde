"""Quality by compression: how much better a text compresses with a dictionary of good texts than of bad ones.

Two pairs of zstandard dictionaries are cut from labelled texts: one pair of the bytes, one of their
shape (runs of letters and of digits become one character), which carries over to words never seen.  The
differences of the compressed sizes, divided by their sum, and the plain compressed size per byte, which
tells endless repetition, are turned into a calibrated score by a logistic fit on labelled texts that the
dictionaries were not cut from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import held_out, pick
from corpusflow.llm.labelled import fit_logistic, labelled_sample, sigmoid

#: Bound of the labelled sample: ids of each label.
PER_CLASS = 2000
#: Characters that one text gives to a dictionary, texts that give them, and bytes of a dictionary.
EXCERPT_CHARS, EXCERPTS = 2000, 400
DICTIONARY_BYTES, SHAPE_DICTIONARY_BYTES = 256 << 10, 64 << 10
#: A text is compressed in blocks, so that the dictionary counts all along and memory is bounded.
BLOCK_BYTES = 4096
LEVEL = 6
#: Added to the size of a text before the plain compressed size is divided by it.
SMALL_TEXT_BYTES = 20

_CLASSES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", b"A" * 26 + b"a" * 26 + b"0" * 10
)


def shape(text: bytes) -> bytes:
    """Letters by case, digits as 0, other ASCII as it is; runs of letters are one letter."""
    classes = re.sub(rb"[\x80-\xff]+", b"a", text.translate(_CLASSES))
    return re.sub(rb"([Aa])\1+", rb"\1", classes)


def blocks(text: str) -> Iterator[bytes]:
    data = text.encode()
    return (data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES))


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries as ``(good, bad)`` pairs and the fitted calibration; without dictionaries the score is ``base``."""

    pairs: tuple[tuple[bytes, bytes], ...]
    mean: tuple[float, ...] = ()
    spread: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    base: float = 0.5

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = (x - np.array(self.mean)) / np.array(self.spread)
        return np.column_stack([np.ones(len(z)), z, np.clip(z, -3, 3) ** 2, z[:, 0] * z[:, 1]])

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.pairs:
            return np.full(len(texts), self.base)
        return sigmoid(self.expand(features(texts, self.pairs)) @ np.array(self.weights))


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    if dictionary is None:
        return zstandard.ZstdCompressor(level=3, write_content_size=False)
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def features(texts: list[str], pairs: tuple[tuple[bytes, bytes], ...]) -> np.ndarray:
    """One row per text: the normalised size difference of each pair, and the log of the plain size per byte."""
    coders = [(_compressor(good), _compressor(bad)) for good, bad in pairs]
    rows = np.zeros((len(texts), len(pairs) + 1))
    for row, text in zip(rows, texts, strict=True):
        sizes = np.zeros((len(pairs), 2))
        plain = _compressor(None).compressobj()
        out = length = 0
        for block in blocks(text):
            out += len(plain.compress(block))
            length += len(block)
            for i, ((good, bad), view) in enumerate(zip(coders, (block, shape(block)), strict=True)):
                sizes[i] += len(good.compress(view)), len(bad.compress(view))
        out += len(plain.flush())
        total = sizes.sum(axis=1)
        row[:-1] = np.divide(sizes[:, 1] - sizes[:, 0], total, out=np.zeros(len(pairs)), where=total > 0)
        row[-1] = np.log(out / (length + SMALL_TEXT_BYTES))
    return rows


def _excerpts(sample: DataFrame, label: int) -> list[bytes]:
    """Stretches at hashed places of ``EXCERPTS`` texts of one label."""
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.char_length("text") - EXCERPT_CHARS, F.lit(0)) + 1)
    rows = sample.where((F.col("label") == label) & F.col("cut")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXCERPTS)
    rows = rows.select(F.substring("text", place.cast("int") + 1, F.lit(EXCERPT_CHARS)).alias("part")).collect()
    return [row["part"].encode() for row in rows]


def fit_quality(documents: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Learn from at most ``PER_CLASS`` ids of each label; half of them make the dictionaries, half the calibration."""
    sample, counts = labelled_sample(documents, labels, label, PER_CLASS)
    base = (counts[1] + 1) / (counts[0] + counts[1] + 2)
    sample = sample.withColumn("cut", F.xxhash64("doc_id", F.lit("half")) % 2 == 0)
    good, bad = _excerpts(sample, 1), _excerpts(sample, 0)
    if not good or not bad:
        return QualityModel((), base=base)
    pairs = (
        tuple(b"".join(part)[:DICTIONARY_BYTES] for part in (good, bad)),
        tuple(b"".join(map(shape, part))[:SHAPE_DICTIONARY_BYTES] for part in (good, bad)),
    )

    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series(list(features(texts.tolist(), pairs)))

    rows = sample.where("NOT cut").select("label", measure("text").alias("x")).collect()
    y = np.array([row["label"] for row in rows], float)
    if len(set(y)) < 2:
        return QualityModel((), base=base)
    x = np.array([row["x"] for row in rows])
    # the sample has as many of both; the score should be right for the shares there are
    share = {value: counts[value] / max(1, np.sum(y == value)) for value in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    weight = weight * len(y) / weight.sum()
    model = QualityModel(pairs, tuple(x.mean(axis=0)), tuple(x.std(axis=0) + 1e-9))
    weights = fit_logistic(model.expand(x), y, weight, ridge=1e-2)
    return QualityModel(pairs, model.mean, model.spread, tuple(weights), base)


def score_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, held_out, score`` for each row of ``documents`` (``doc_id, text``), by the whole text.

    A null text scores like an empty one, which has no size differences.  Without labels of both kinds all
    rows score the share of label 1.  A null id counts as held out.  Ids may repeat; no rows give no rows;
    further columns are not looked at.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(texts.tolist()))

    rows = pick(documents, "doc_id", "text")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.coalesce("text", F.lit(""))).alias("score"))
