"""Personal data by candidate spans and boosted trees, in DataFrame operations only.

For each kind two generators propose spans: the base pattern, and a wide one that also takes broken, spelt-out
and unusually written forms; the spans of the two may overlap.  Base spans that pass their check are always
kept.  Boosted trees learn, from the format of a span and the text around it, what such spans look like:
the spans that pass are the positive examples, those that no such span touches are the others, and
the checks themselves are no feature.  On a fold that the trees have not seen the threshold is
calibrated: the lowest score from which the wanted share of spans is positive.  Further candidates that
reach it are kept as well.

Places come from ``split`` and ``regexp_extract_all`` with one pattern: the pieces between matches and the matches,
laid end to end, are the text.  Only spans are shuffled, never texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import null_safe_join, pick, staged, with_key

#: Kinds in the order in which spans that start at one place are listed.
KINDS = ("email", "ip", "card", "phone")

# Quantifiers that need not give anything back are possessive, which keeps the matcher from recursing on long
# runs; a start inside a run that an earlier start has tried is skipped.  The matches are those of the plain patterns.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+",
    "ip": r"(?:\G|(?<![0-9A-Fa-f:.]))[0-9A-Fa-f]{1,4}+(?:[.:][0-9A-Fa-f]{1,4}+){3,7}+(?![0-9A-Fa-f])",
    "card": r"(?:\G|(?<![0-9]))[0-9]{3,6}+(?:[\x20./_-]{1,2}+[0-9]{3,6}+){2,5}+(?![0-9])",
    "phone": r"(?:\G|(?<![0-9]))(?:\+|00|\()?[0-9]{1,4}+\)?+(?:[\x20()./-]{1,3}+[0-9]{2,5}+){2,5}+(?![0-9])",
}
#: What a text has to hold for a pattern to be tried at all.
HINT = {"email": r"@|\(at\)|\[at\]", "ip": r"[0-9]", "card": r"[0-9]{2}|[0-9][\x20-][0-9]", "phone": r"\+[0-9]|[0-9]{2}[\x20()./-]"}

#: Characters of context on either side of a span.
CONTEXT = 24
#: Number and depth of the trees.
TREES, DEPTH = 20, 3
#: Share of positives among the spans of the calibration fold that reach the threshold.
PRECISION = 0.95
FOLDS = 3

SPAN_KEY = ("doc_id", "text_key", "kind", "generator")


def _matches(kind: str, generator: str, pattern: str) -> Column:
    """Matches of one pattern with their number, the length of the piece before, and their context."""
    text = F.col("text")
    pieces = F.split(text, pattern, -1)
    # side by side first, so that a match costs its own length however many there are
    around = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), pieces.alias("before"), F.slice(pieces, 2, 2**30).alias("after")
    )

    def span(found: Column, at: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(generator).alias("generator"), at.alias("number"), found["match"].alias("match"),
            F.char_length(found["before"]).alias("gap"), F.right(found["before"], F.lit(CONTEXT)).alias("before"),
            F.left(found["after"], F.lit(CONTEXT)).alias("after"),
        )

    # there is one piece more than there are matches
    found = F.transform(F.filter(around, lambda pair: pair["match"].isNotNull()), span)
    return F.when(text.rlike(HINT[kind]), found).otherwise(F.array().cast(
        "array<struct<kind:string,generator:string,number:int,match:string,gap:int,before:string,after:string>>"))


def _digits() -> Column:
    return F.regexp_replace("match", "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; looks at 19 digits at most."""
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        double = F.when(i % 2 == 1, 2 * digit).otherwise(digit)
        return total + F.when(double > 9, double - 9).otherwise(double)

    places = F.sequence(F.lit(0), F.least(F.char_length(digits), F.lit(19)) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _passes() -> Column:
    """The check of each kind, for matches of its base pattern."""
    parts = F.transform(F.split("match", r"\."), lambda part: F.regexp_replace(part, "^0+(?=.)", ""))
    small = F.forall(parts, lambda part: (F.char_length(part) <= 3) & (F.substring(part, 1, 3).cast("int") <= 255))
    length = F.char_length(_digits())
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", F.when(length.between(12, 19), _luhn(_digits())).otherwise(False))
        .otherwise(length.between(9, 15))
    )


def candidates(documents: DataFrame) -> DataFrame:
    """Proposed spans: ``doc_id, text_key, kind, generator, start, end, match, before, after, base``, written out."""
    found = reduce(F.concat, [_matches(kind, name, rule[kind]) for name, rule in (("base", BASE), ("wide", WIDE)) for kind in KINDS])
    spans = documents.select("doc_id", F.xxhash64("text").alias("text_key"), F.inline(found))
    # copies of a document propose the same spans
    spans = spans.dropDuplicates([*SPAN_KEY, "number"])
    so_far = Window.partitionBy(*SPAN_KEY).orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("match")
    end = F.sum(F.col("gap") + length).over(so_far)
    return staged(
        spans.withColumn("end", end).withColumn("start", F.col("end") - length)
        .withColumn("base", (F.col("generator") == "base") & _passes())
        .drop("number", "gap"),
        "span-candidates",
    )


def _fresh(spans: DataFrame) -> DataFrame:
    """Candidates that no base span of their kind touches, each place once."""
    # base spans of a kind do not overlap, so the one before and the one after decide
    of_kind = Window.partitionBy("doc_id", "text_key", "kind")
    before = of_kind.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = of_kind.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    placed = spans.withColumns({
        "base_end": F.max(F.when(F.col("base"), F.col("end"))).over(before),
        "base_start": F.min(F.when(F.col("base"), F.col("start"))).over(after),
    })
    touched = (F.coalesce("base_end", F.lit(0)) > F.col("start")) | F.coalesce(F.col("base_start") < F.col("end"), F.lit(False))
    others = placed.where(~F.col("base") & ~touched).drop("base_end", "base_start")
    return others.dropDuplicates(["doc_id", "text_key", "kind", "start", "end"])


def _with_features(spans: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context of a span as numbers.  None of them is a check of its kind."""
    def count(column: str, pattern: str) -> Column:
        return F.char_length(column) - F.char_length(F.regexp_replace(column, pattern, ""))

    runs = F.filter(F.split("match", "[^0-9]+"), lambda run: run != "")
    sizes = F.transform(runs, lambda run: F.char_length(run))
    last = F.right(F.col("before"), F.lit(1))
    first = F.left(F.col("after"), F.lit(1))
    features = {
        **{f"is_{kind}": F.col("kind") == kind for kind in KINDS},
        "chars": F.char_length("match"),
        "digits": count("match", "[0-9]"),
        "letters": count("match", "[A-Za-z]"),
        "dots": count("match", r"[.]"),
        "dashes": count("match", r"[-_/]"),
        "spaces": count("match", r"[\x20]"),
        "brackets": count("match", r"[()\[\]]"),
        "plus": F.startswith(F.col("match"), F.lit("+")),
        "runs": F.size(runs),
        "longest_run": F.coalesce(F.array_max(sizes), F.lit(0)),
        "shortest_run": F.coalesce(F.array_min(sizes), F.lit(0)),
        "last_run": F.coalesce(F.try_element_at(sizes, F.lit(-1)), F.lit(0)),
        "different_digits": F.size(F.array_distinct(F.filter(F.split("match", ""), lambda c: c.rlike("[0-9]")))),
        "after_space": last.rlike(r"\s") | (last == ""),
        "after_letter": last.rlike(r"\p{L}"),
        "after_digit": last.rlike("[0-9]"),
        "after_mark": last.rlike(r"[=:\"'#$/.-]"),
        "then_space": first.rlike(r"\s") | (first == ""),
        "then_letter": first.rlike(r"\p{L}"),
        "then_digit": first.rlike("[0-9]"),
        "then_mark": first.rlike(r"[=:\"'#$/.@-]"),
        "digits_before": count("before", "[0-9]"),
        "digits_after": count("after", "[0-9]"),
        "letters_before": count("before", r"\p{L}"),
        "letters_after": count("after", r"\p{L}"),
    }
    return spans.withColumns({f"f_{name}": column.cast("double") for name, column in features.items()}), [f"f_{name}" for name in features]


def _counted(examples: DataFrame, names: list[str]) -> DataFrame:
    """``seen, label, weight`` and the features: all examples, those alike in one row; the fold that is not seen is for calibration."""
    seen = (F.pmod(F.xxhash64("text_key"), F.lit(FOLDS)) > 0).alias("seen")
    return examples.groupBy(seen, "label", *names).agg(F.count("*").cast("double").alias("weight"))


def _fit(examples: DataFrame, names: list[str]) -> tuple[GBTClassificationModel, float] | None:
    """Trees and the calibrated threshold, both from all examples; nothing where one sort of example is missing."""
    counted = staged(_counted(examples, names), "span-examples")
    sorts = {(row["seen"], row["label"]) for row in counted.select("seen", "label").distinct().collect()}
    if len(sorts) < 4:
        return None
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1)
    model = trees.fit(vectors.transform(counted.where("seen")))
    # a thousand bins of the score at most, from the highest
    scored = model.transform(vectors.transform(counted.where("NOT seen")))
    bins = scored.groupBy(F.floor(vector_to_array("probability")[1] * 1000).alias("bin")).agg(
        F.sum(F.col("label") * F.col("weight")).alias("hits"), F.sum("weight").alias("n")
    )
    threshold, hits, n = float("inf"), 0.0, 0
    for row in sorted(bins.collect(), key=lambda row: -row["bin"]):
        hits, n = hits + row["hits"], n + row["n"]
        if hits >= PRECISION * n:
            threshold = row["bin"] / 1000
    return model, threshold


def personal_spans(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans`` for each row of ``documents`` (``doc_id, text``).

    ``spans`` are all spans, ``kind, start, end`` in code points with the end exclusive, ``base``, sorted by start,
    then by kind as in ``KINDS``, then by end; ``text_key`` is ``xxhash64(text)``.  Null and empty texts have none.  Documents are told
    apart by id and text, so ids may repeat or be null and copies have equal spans.  Without examples of both sorts
    the base spans are all.  No rows give no rows; further columns are not looked at.
    """
    rows = pick(documents, "doc_id", "text")
    spans = candidates(rows)
    fresh = _fresh(spans)
    described, names = _with_features(spans.where("base").unionByName(fresh))
    described = staged(described.withColumn("label", F.col("base").cast("double")), "spans")
    fitted = _fit(described, names)
    chosen = described.where("base")
    if fitted is not None and fitted[1] != float("inf"):
        model, threshold = fitted
        scored = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(described.where("NOT base")))
        chosen = chosen.unionByName(scored.where(vector_to_array("probability")[1] >= threshold).select(described.columns))
    order = F.array_position(F.array(*[F.lit(kind) for kind in KINDS]), F.col("kind"))
    per_document = chosen.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", order.alias("order"), "end", "kind", "base"))).alias("spans")
    )
    empty = F.array().cast(per_document.schema["spans"].dataType)
    keyed = rows.select("doc_id", F.xxhash64("text").alias("text_key"))
    return null_safe_join(keyed, per_document, ["doc_id", "text_key"], "left").withColumn("spans", F.coalesce("spans", empty))


def _masked(text: Column, spans: Column) -> Column:
    """A text with its sorted spans replaced; what a span shares with an earlier one is replaced once."""
    zero = F.struct(F.lit(0).cast("bigint").alias("upto"), F.array().cast("array<string>").alias("parts"))

    def add(so_far: Column, span: Column) -> Column:
        between = F.substring(text, (so_far["upto"] + 1).cast("int"), (span["start"] - so_far["upto"]).cast("int"))
        mask = F.concat(F.lit("["), span["kind"], F.lit("]"))
        fresh = F.concat(so_far["parts"], F.array(between, mask))
        inside = span["start"] < so_far["upto"]
        return F.struct(
            F.greatest(so_far["upto"], span["end"]).alias("upto"), F.when(inside, so_far["parts"]).otherwise(fresh).alias("parts")
        )

    def finish(so_far: Column) -> Column:
        tail = F.substring(text, (so_far["upto"] + 1).cast("int"), F.char_length(text))
        return F.concat(F.array_join(so_far["parts"], ""), tail)

    return F.aggregate(spans, zero, add, finish)


def redact(documents: DataFrame) -> DataFrame:
    """``documents`` with the spans of :func:`personal_spans` replaced by ``[kind]``, all columns and names as they are."""
    names = documents.columns
    found = personal_spans(documents).where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"])
    joined = null_safe_join(with_key(documents), found, ["doc_id", "text_key"], "left")
    text = f"c{names.index('text')}"
    masked = F.when(F.col("spans").isNull(), F.col(text)).otherwise(_masked(F.col(text), F.col("spans")))
    return joined.select(*[masked if f"c{i}" == text else F.col(f"c{i}") for i in range(len(names))]).toDF(*names)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
