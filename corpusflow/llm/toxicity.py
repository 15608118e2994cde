"""Toxicity by weak supervision.

Voters are words and word beginnings that the labelled sample shows far more often in toxic texts,
and patterns (shouting, exclamation, repetition) cut where they tell most.  A generative label model
learns by expectation maximisation, on labelled and unlabelled texts, how often each voter fires on toxic
and on other texts, and how voters go together beyond that; voters that say the same share their weight.
Its posterior labels train a linear classifier over many more features than there are voters, which
scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import held_out, pick
from corpusflow.llm.labelled import fit_logistic, labelled_sample, sigmoid

#: Bounds of the sample: ids of each label, and ids without one.
PER_CLASS, UNLABELLED = 3000, 3000
#: Lengths of word beginnings, and the shares of a text's words (one in so many) that are features of their own.
BEGINNINGS = (4, 5, 6, 7)
SHARES = (200, 100, 50)
#: Lexicon voters, and features of the classifier.
VOTERS, FEATURES = 200, 600
#: Labelled toxic texts that a feature has to be in, and how many times as often as in others.
SUPPORT, RATIO = 3, 8.0
#: Likelihood ratio (G) that tells a feature from chance; one word in a million reaches it without a reason.
SIGNIFICANT = 24.0
EM_ROUNDS = 25
#: How much more often a pattern has to hold on one kind of text than on the other.
PATTERN_GAIN = 0.2
#: Share of the labels that may be wrong.
LABEL_NOISE = 0.01
#: Counts that a task gathers before it passes them on.
COUNTS_AT_ONCE = 300_000

_WORD = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def beginnings(counts: Counter, size: int) -> Counter:
    """How many words of a text begin with each string of ``size`` letters."""
    starts: Counter = Counter()
    for word, count in counts.items():
        if len(word) >= size:
            starts[word[:size]] += count
    return starts


def features(words: list[str]) -> set[str]:
    """Words, beginnings of words, and beginnings that two or more words and at least a share of all words have."""
    counts = Counter(words)
    found = set(counts)
    for size in BEGINNINGS:
        for start, count in beginnings(counts, size).items():
            found.add(f"^{start}")
            if count > 1:
                found.update(f"^{start}/{share}" for share in SHARES if count * share >= len(words))
    return found


def patterns(text: str, words: list[str]) -> list[float]:
    """Measures of the whole text: shouting, exclamation marks, symbols, repetition, word length."""
    n, length = max(1, len(words)), max(1, len(text))
    letters = max(1, sum(map(len, words)))
    return [
        sum(map(str.isupper, text)) / letters,
        text.count("!") / n,
        (length - letters) / length,
        1 - len(set(words)) / n,
        letters / n,
    ]


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of the linear classifier; without features the score is the base rate.

    ``starts`` has the weights of word beginnings: of a beginning as such (share 0) and of its shares.
    """

    bias: float
    words: dict[str, float] = field(default_factory=dict)
    starts: dict[str, list[tuple[int, float]]] = field(default_factory=dict)
    pattern_cuts: tuple[float, ...] = ()
    pattern_weights: tuple[float, ...] = ()

    @staticmethod
    def of(bias: float, weights: dict[str, float], cuts: list[float], pattern_weights: list[float]) -> ToxicityModel:
        words, starts = {}, {}
        for name, weight in weights.items():
            if name.startswith("^"):
                start, _, share = name[1:].partition("/")
                starts.setdefault(start, []).append((int(share or 0), weight))
            else:
                words[name] = weight
        return ToxicityModel(bias, words, starts, tuple(cuts), tuple(pattern_weights))

    def score(self, text: str) -> float:
        listed = tokens(text)
        counts, z, n = Counter(listed), self.bias, len(listed)
        z += sum(self.words[word] for word in counts.keys() & self.words.keys())
        starts, seen = self.starts, Counter()
        for word, count in counts.items():
            for size in BEGINNINGS:
                if len(word) >= size and (start := word[:size]) in starts:
                    seen[start] += count
        for start, count in seen.items():
            z += sum(weight for share, weight in starts[start] if not share or (count > 1 and count * share >= n))
        if any(self.pattern_weights):
            fired = np.array(patterns(text, listed)) > np.array(self.pattern_cuts)
            z += float(fired @ np.array(self.pattern_weights))
        return float(sigmoid(np.array(z)))


def _feature_counts(sample: DataFrame) -> DataFrame:
    """``feature, clean, toxic``: labelled texts of either kind that have it; every task adds up its own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for name in features(tokens(text.as_py())):
                    counts.setdefault(name, [0, 0])[label] += 1
                if len(counts) > COUNTS_AT_ONCE:
                    yield as_batch(counts)
                    counts = {}
        yield as_batch(counts)

    def as_batch(counts: dict[str, list[int]]) -> pa.RecordBatch:
        columns = [list(counts), [c[0] for c in counts.values()], [c[1] for c in counts.values()]]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["feature", "clean", "toxic"])

    partial = sample.where("label IS NOT NULL").select("label", "text").mapInArrow(count, "feature STRING, clean BIGINT, toxic BIGINT")
    return partial.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _likelihood_ratio(n_clean: int, n_toxic: int) -> Column:
    """How much better two rates explain the counts of a feature than one does."""
    clean, toxic = F.col("clean"), F.col("toxic")
    share = (clean + toxic) / (n_clean + n_toxic)

    def part(hits: Column, n: int, rate: Column) -> Column:
        return F.when(hits > 0, hits * F.log(hits / (n * rate))).otherwise(0.0)

    return 2 * (
        part(clean, n_clean, share) + part(toxic, n_toxic, share)
        + part(n_clean - clean, n_clean, 1 - share) + part(n_toxic - toxic, n_toxic, 1 - share)
    )


@dataclass
class LabelModel:
    """How voters vote: rates of firing on clean and toxic texts, and the weight that their correlations leave them.

    A voter that does not fire abstains.  The last voter fires where no word does.
    """

    prior: float
    rates: np.ndarray  # (2, voters)
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        fired = self.weight * np.log(self.rates[1] / self.rates[0])
        return sigmoid(np.log(self.prior / (1 - self.prior)) + votes @ fired)


def _smooth(hits: np.ndarray, total: float) -> np.ndarray:
    return np.clip((hits + 0.5) / (total + 1), 1e-4, 1 - 1e-4)


def _share_of_correlated(votes: np.ndarray, posterior: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """One over the number of voters that say the same: correlations of what the classes do not explain."""
    expected = np.outer(1 - posterior, rates[0]) + np.outer(posterior, rates[1])
    residual = votes - expected
    covariance = residual.T @ residual / max(1, len(votes))
    scale = np.sqrt(np.diag(covariance)) + 1e-9
    return 1 / np.clip(covariance / np.outer(scale, scale), 0, 1).sum(axis=1).clip(min=1)


def fit_label_model(votes: np.ndarray, labels: np.ndarray, prior: float) -> LabelModel:
    """Expectation maximisation over all rows of ``votes``.

    It starts from the rows whose ``labels`` are not negative, and these rows stay as good as certain, so that the
    classes cannot drift from what the labels mean.
    """
    labelled = labels >= 0
    known = [votes[labels == value] for value in (0, 1)]
    rates = np.stack([_smooth(k.sum(axis=0), len(k)) for k in known])
    model = LabelModel(prior, rates, np.ones(votes.shape[1]))
    certain = np.where(labels == 1, 1 - LABEL_NOISE, LABEL_NOISE)
    model.weight = _share_of_correlated(votes[labelled], certain[labelled], rates)
    for _ in range(EM_ROUNDS):
        posterior = np.where(labelled, certain, model.posterior(votes))
        totals = (len(posterior) - posterior.sum(), posterior.sum())
        fresh = np.stack([_smooth((1 - posterior) @ votes, totals[0]), _smooth(posterior @ votes, totals[1])])
        moved = np.abs(fresh - model.rates).max()
        model = LabelModel(prior, fresh, _share_of_correlated(votes, posterior, fresh))
        if moved < 1e-4:
            break
    return model


def _best_cut(values: np.ndarray, labels: np.ndarray) -> float:
    """Where a pattern tells toxic from clean texts best; infinity where it tells nothing."""
    cuts = np.unique(np.quantile(values, np.linspace(0.02, 0.98, 33)))
    gains = [abs((values[labels == 1] > cut).mean() - (values[labels == 0] > cut).mean()) for cut in cuts]
    return float(cuts[int(np.argmax(gains))]) if max(gains) > PATTERN_GAIN else float("inf")


def fit_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> ToxicityModel:
    """Learn from at most ``PER_CLASS`` ids of each label and ``UNLABELLED`` others."""
    sample, counts = labelled_sample(documents, labels, label, PER_CLASS, UNLABELLED)
    base = (counts[1] + 1) / (counts[0] + counts[1] + 2)
    empty = ToxicityModel(float(np.log(base / (1 - base))))
    seen = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if not seen.get(0) or not seen.get(1):
        return empty
    toxic, clean = F.col("toxic") / seen[1], (F.col("clean") + 0.5) / seen[0]
    telling = (
        _feature_counts(sample)
        .where((F.col("toxic") >= SUPPORT) & (toxic >= RATIO * clean) & (_likelihood_ratio(seen[0], seen[1]) >= SIGNIFICANT))
        .orderBy((F.col("toxic") * F.log(toxic / clean)).desc(), "feature")
        .limit(FEATURES)
    )
    names = [row["feature"] for row in telling.collect()]
    if not names:
        return empty
    place = {name: i for i, name in enumerate(names)}

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.as_py() for text in batch.column(1)]
            words = [tokens(text) for text in texts]
            fired = [sorted(place[name] for name in features(w) if name in place) for w in words]
            measures = [patterns(text, w) for text, w in zip(texts, words, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fired, pa.list_(pa.int32())), pa.array(measures, pa.list_(pa.float64()))],
                ["label", "fired", "measures"],
            )

    # at most 2 * PER_CLASS + UNLABELLED rows of numbers
    rows = sample.select("label", "text").mapInArrow(vote, "label INT, fired ARRAY<INT>, measures ARRAY<DOUBLE>").collect()
    known = np.array([-1 if row["label"] is None else row["label"] for row in rows])
    fired = np.zeros((len(rows), len(names)), np.float32)
    for i, row in enumerate(rows):
        fired[i, row["fired"]] = 1
    measures = np.array([row["measures"] for row in rows])
    cuts = np.array([_best_cut(column[known >= 0], known[known >= 0]) for column in measures.T])
    shouting = (measures > cuts).astype(np.float32)
    lexicon = fired[:, :VOTERS]
    votes = np.hstack([lexicon, shouting, ~lexicon.any(axis=1, keepdims=True)])
    posterior = fit_label_model(votes, known, base).posterior(votes)
    # the sample has as many labelled texts of both kinds; weigh them as often as they are there
    share = {value: counts[value] / seen[value] for value in (0, 1)}
    weight = np.select([known == 0, known == 1], [share[0], share[1]], (counts[0] + counts[1]) / max(1, seen.get(None, 0)))
    weight = weight * len(weight) / weight.sum()
    x = np.hstack([np.ones((len(rows), 1), np.float32), fired, shouting]).astype(float)
    fitted = fit_logistic(x, posterior, weight, ridge=0.03)
    inner = fitted[1 : 1 + len(names)]
    outer = np.where(np.isfinite(cuts), fitted[1 + len(names) :], 0.0)
    return ToxicityModel.of(float(fitted[0]), dict(zip(names, inner.tolist(), strict=True)), cuts.tolist(), outer.tolist())


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([model.score(text.as_py()) for text in texts], pa.float64())

    return score(F.coalesce(text, F.lit("")))


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score`` for each row of ``documents`` (``doc_id, text``), by the whole text.

    A null text scores like an empty one: no voter fires.  Without labels of both kinds all rows score the share
    of label 1.  A null id counts as held out.  Ids may repeat; no rows give no rows; further columns are
    not looked at.
    """
    rows = pick(documents, "doc_id", "text")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity_score(F.col("text"), model).alias("score"))


def drop_toxic(documents: DataFrame, model: ToxicityModel, threshold: float) -> DataFrame:
    """``documents`` that score below ``threshold``, all columns and names as they are."""
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    scored = plain.withColumn("score", toxicity_score(F.col(f"c{names.index('text')}"), model))
    return scored.where(F.col("score") < threshold).drop("score").toDF(*names)
