"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is ``SPAN`` consecutive words of a benchmark item (an item of fewer words is one window).  Every
run of ``SPAN`` words holds ``SPAN - K + 1`` neighbouring k-grams, and the smallest of their hashes is the
fingerprint of the run: equal runs have equal fingerprints, so joining the fingerprints of documents
and items finds every shared run, and most other runs drop out there.  Hits are then extended
to their whole window, and the words themselves decide.

A document is cut into words once.  What is shuffled are one row per document and the places of
its hits; texts of documents with hits are read a second time.  Nothing is broadcast by hand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import null_safe_join, pick, staged, without_documents

#: Words of a window.
SPAN = 10
#: Words of the k-grams that are hashed; windows of ``SPAN - K + 1`` of them keep their minimum.
K = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What lies between words, once A-Z are lower-cased.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def _hash_pair(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _join_neighbours(left: Column, right: Column, shift: int, combine) -> Column:
    """``combine`` of each element and the one ``shift`` places on in ``right``; garbage at the end."""
    return F.zip_with(left, F.slice(right, F.lit(shift + 1), F.size(right)), combine)


def _with_grams(df: DataFrame, size: int, name: str) -> DataFrame:
    """Hashes of all runs of ``size`` words, from ``hashes`` of single words, in a logarithmic number of steps."""
    length, have = 1, "hashes"
    steps = {1: "hashes"}
    while 2 * length <= size:
        df = df.withColumn(f"{name}_{2 * length}", _join_neighbours(F.col(have), F.col(have), length, _hash_pair))
        length, have = 2 * length, f"{name}_{2 * length}"
        steps[length] = have
    for more in sorted(steps, reverse=True):
        if length + more <= size:
            df = df.withColumn(f"{name}_{length + more}", _join_neighbours(F.col(have), F.col(steps[more]), length, _hash_pair))
            length, have = length + more, f"{name}_{length + more}"
    return df.withColumn(name, F.col(have))


def _with_minima(df: DataFrame, grams: str, width: int, name: str) -> DataFrame:
    """The smallest of ``width`` neighbours, at each place."""
    length, have = 1, grams
    while length < width:
        step = min(length, width - length)
        df = df.withColumn(f"{name}_{length + step}", _join_neighbours(F.col(have), F.col(have), step, _least))
        length, have = length + step, f"{name}_{length + step}"
    return df.withColumn(name, F.col(have))


def _mark(length: int):
    def mark(value: Column, at: Column) -> Column:
        return F.struct(F.lit(length).alias("length"), at.alias("start"), value.alias("mark"))

    return mark


def _with_marks(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add ``marks``: a fingerprint for every run of each length, with its length and place."""
    df = df.withColumn("n_words", F.size("words")).withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))
    marks = []
    for length in lengths:
        if length == SPAN:
            df = _with_minima(_with_grams(df, K, "gram"), "gram", SPAN - K + 1, "least")
            column = F.col("least")
        else:
            df = _with_grams(df, length, f"run{length}")
            column = F.col(f"run{length}")
        runs = F.slice(column, F.lit(1), F.greatest(F.col("n_words") - (length - 1), F.lit(0)))
        marks.append(F.transform(runs, _mark(length)))
    return df.withColumn("marks", reduce(F.concat, marks))


def _window_text(tokens: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(tokens, start + 1, length), " ")


def contaminated_words(documents: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """Hits of the windows of ``benchmark`` (``item_id, text``) in each row of ``documents`` (``doc_id, text``).

    Returns ``doc_id, text_key, n_words, n_hit, item_ids`` (distinct, sorted as strings), one row per document
    row; ``text_key`` is ``xxhash64(text)``.  Null and empty texts have no words and no hits; an item without
    words has no window.  Documents are told apart by id and text, so ids may repeat or be null.  An item
    is its id: rows that share one are one item, and hits of items without an id count as hit words only.
    No rows give no rows.  Further columns are not looked at.
    """
    if span != SPAN:
        raise ValueError(f"windows are {SPAN} words long")
    items = pick(benchmark, "item_id", "text").select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = staged(items.withColumn("length", F.least(F.size("words"), F.lit(span))), "benchmark-words")
    # at most ``span`` numbers
    lengths = sorted(row["length"] for row in items.select("length").distinct().collect())
    base = pick(documents, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    if not lengths:
        return base.select(
            "doc_id", "text_key", F.size(words(F.col("text"))).alias("n_words"), F.lit(0).alias("n_hit"),
            F.array().cast("array<string>").alias("item_ids"),
        )
    windows = (
        _with_marks(items, lengths)
        .select("item_id", "words", "length", F.explode("marks").alias("m"))
        .where("m.length = length")
        .select("item_id", "length", F.col("m.mark").alias("mark"), _window_text(F.col("words"), F.col("m.start"), F.col("length")).alias("window"))
    )
    windows = staged(windows.distinct(), "benchmark-windows")

    # one row for the document itself (length 0; its own mark, so that these rows spread) and one for each run
    own = F.array(F.struct(F.lit(0).alias("length"), F.lit(0).alias("start"), F.col("text_key").alias("mark")))
    runs = _with_marks(base.withColumn("words", words(F.col("text"))), lengths).select(
        "doc_id", "text_key", "n_words", F.inline(F.concat(own, "marks"))
    )
    known = windows.select("length", "mark").distinct().withColumn("known", F.lit(True))
    found = (
        runs.join(known, ["length", "mark"], "left")
        .where("length = 0 or known")
        .groupBy("doc_id", "text_key", "n_words")
        .agg(
            F.count(F.when(F.col("length") == 0, 1)).alias("copies"),
            F.collect_set(F.when(F.col("length") > 0, F.struct("start", "length"))).alias("places"),
        )
    )
    found = staged(found, "winnowed")

    candidates = found.where(F.size("places") > 0).select("doc_id", "text_key", "places")
    same = ["doc_id", "text_key"]
    occurrences = (
        null_safe_join(base, candidates, same, "inner")
        .withColumn("words", words(F.col("text")))
        .select(
            *same,
            F.inline(F.transform("places", lambda p: F.struct(
                p["start"].alias("start"), p["length"].alias("length"),
                _window_text(F.col("words"), p["start"], p["length"]).alias("window")))),
        )
    )
    hits = (
        occurrences.join(windows.select("item_id", "window", "length"), ["window", "length"])
        .groupBy(*same)
        .agg(
            F.array_sort(F.collect_set(F.struct("start", "length"))).alias("places"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
        )
        .withColumn("n_hit", _covered(F.col("places")))
        .drop("places")
    )
    result = null_safe_join(found.drop("places"), hits, same, "left")
    return result.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without a hit, all columns and names as they are."""
    hits = contaminated_words(documents, benchmark).where("n_hit > 0").select("doc_id", "text_key").distinct()
    return without_documents(documents, hits)


def _covered(places: Column) -> Column:
    """Words inside any of the sorted ``(start, length)`` places."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(so_far: Column, place: Column) -> Column:
        end = F.greatest(so_far["end"], place["start"] + place["length"])
        fresh = F.greatest(F.lit(0), end - F.greatest(so_far["end"], place["start"]))
        return F.struct(end.alias("end"), (so_far["n"] + fresh).alias("n"))

    return F.aggregate(places, zero, add, lambda total: total["n"])
