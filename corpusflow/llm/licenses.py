"""Licences of files: TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

Every line, every paragraph and the whole of a text is compared, as a sparse vector of its words, with the
templates; a word no template has counts in the length of the vector with the highest weight.  The best
unit at ``THRESHOLD`` or more names the licence of the file.  A file with one such unit of half of its words is a licence
file: it also speaks for its directory.  So does a file that as a whole is one of the full texts in ``license_texts``, at
``TEXT_THRESHOLD`` or more.  A file without a licence of its own takes that of the
nearest directory above it that has one.

Directories are resolved once each, by joining the paths above them with the directories that have a licence;
files then join their directory.  Texts are not shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import null_safe_join, pick, staged

#: Notices by SPDX name (fixed values: the usual wording of each).
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    ],
    "LGPL-2.1": ["This library is licensed under the GNU Lesser General Public License, version 2.1"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3"],
    "BSD": [
        "Licensed under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "proprietary": ["All rights reserved"],
}
#: Cosine from which a unit counts, and the share of a text's words that makes it a licence file.
THRESHOLD, FILE_SHARE = 0.7, 0.5

#: Cosine from which a text is the full text of a licence, and how much longer or shorter it may be.
TEXT_THRESHOLD, TEXT_RATIO = 0.9, 2.0

_WORD = re.compile(r"[^\W_]+")


def terms(text: str) -> Counter:
    """Words of a text; a word of one letter or digit is joined with the one before it, so that versions count."""
    words = _WORD.findall(text.lower())
    found = Counter(words)
    found.update(f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if len(b) == 1)
    return found


class Matcher:
    """Templates as unit vectors over their own words."""

    def __init__(self, templates: dict[str, list[str]], threshold: float) -> None:
        self.threshold = threshold
        listed = [(name, terms(text)) for name, texts in templates.items() for text in texts]
        having = Counter(term for _, found in listed for term in found)
        self.unknown = math.log(1 + len(listed)) + 1
        self.weight = {term: math.log((1 + len(listed)) / (1 + n)) + 1 for term, n in having.items()}
        self.names = [name for name, _ in listed]
        self.by_term: dict[str, list[tuple[int, float]]] = {}
        for i, (_, found) in enumerate(listed):
            length = math.sqrt(sum((n * self.weight[term]) ** 2 for term, n in found.items()))
            for term, n in found.items():
                self.by_term.setdefault(term, []).append((i, n * self.weight[term] / length))

    def best(self, unit: str) -> tuple[float, str]:
        """Highest cosine and its template, of equals the first name."""
        found = terms(unit)
        squares, known = 0.0, 0.0
        products: dict[int, float] = {}
        for term, n in found.items():
            weight = n * self.weight.get(term, self.unknown)
            squares += weight * weight
            if term in self.by_term:
                known += weight * weight
        # the cosine cannot be higher than the share of the vector in known words
        if known < self.threshold * self.threshold * squares or not known:
            return 0.0, ""
        for term, n in found.items():
            for i, value in self.by_term.get(term, ()):
                products[i] = products.get(i, 0.0) + n * self.weight[term] * value
        value, name = min((-product, self.names[i]) for i, product in products.items())
        return -value / math.sqrt(squares), name

    def scan(self, text: str) -> tuple[str | None, float, bool]:
        """Licence of a text, its cosine, and whether the text is a licence file."""
        value, name = full_text(text)
        if name:
            return name, min(1.0, value), True
        lines = text.split("\n")
        units = [*lines, *re.split(r"\n\s*\n", text), text] if len(lines) > 1 else lines
        scored = [(self.best(unit), len(unit.split())) for unit in dict.fromkeys(units)]
        hits = [(score, name, n) for (score, name), n in scored if score >= THRESHOLD]
        if not hits:
            return None, 0.0, False
        score, name, _ = min(hits, key=lambda hit: (-round(hit[0], 9), hit[1]))
        return name, min(1.0, score), max(n for _, _, n in hits) >= FILE_SHARE * max(1, len(text.split()))


@lru_cache(maxsize=1)
def matcher() -> Matcher:
    return Matcher(TEMPLATES, THRESHOLD)


@lru_cache(maxsize=1)
def text_matcher() -> tuple[Matcher, int, int]:
    """Full texts of licences, and the fewest and most words of a text that may be one."""
    folder = resources.files("corpusflow.llm") / "license_texts"
    texts = {file.name.removesuffix(".txt"): [file.read_text()] for file in sorted(folder.iterdir(), key=lambda f: f.name)}
    sizes = [len(text.split()) for (text,) in texts.values()]
    return Matcher(texts, TEXT_THRESHOLD), int(min(sizes) / TEXT_RATIO), int(max(sizes) * TEXT_RATIO)


def full_text(text: str) -> tuple[float, str]:
    """Cosine and name of the licence whose full text this is; no name if it is none."""
    found, fewest, most = text_matcher()
    if not fewest <= len(text.split()) <= most:
        return 0.0, ""
    value, name = found.best(text)
    if value < TEXT_THRESHOLD:
        return 0.0, ""
    # the two differ in one section and the title
    return value, "AGPL-3.0" if name == "GPL-3.0" and "affero" in text[:300].lower() else name


@F.pandas_udf(T.StructType([T.StructField("license", T.StringType()), T.StructField("cosine", T.DoubleType()), T.StructField("file", T.BooleanType())]))
def scan_license(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([matcher().scan(text) for text in texts], columns=["license", "cosine", "file"])


def directory_of(path: Column) -> Column:
    """The directory of a path; the root is the empty string."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def with_all_above(directory: Column) -> Column:
    """A directory and all above it, the nearest first."""
    parts = F.filter(F.split(directory, "/"), lambda part: part != "")
    return F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def scan_licenses(files: DataFrame) -> DataFrame:
    """``path, doc_id, own_license, cosine, license_file, license, inherited_from`` for each row of ``files`` (``path, doc_id, text``).

    ``license`` is the file's own or that of the nearest directory above it with a licence file, ``inherited_from`` that
    directory (the root is the empty string; null where the licence is the file's own or there is none).  Of several licence
    files in a directory the one with the highest cosine counts, then the first by name of the licence.  Null and empty texts
    have no licence of their own; a null path lies in no directory.  Rows may repeat; no rows give no rows; further
    columns are not looked at.
    """
    rows = pick(files, "path", "doc_id", "text").select("path", "doc_id", scan_license(F.coalesce("text", F.lit(""))).alias("found"))
    rows = staged(
        rows.select("path", "doc_id", F.col("found.license").alias("own_license"), F.col("found.cosine").alias("cosine"),
                    F.col("found.file").alias("license_file"), directory_of(F.regexp_replace("path", "^/+|/+(?=/)", "")).alias("directory")),
        "licenses",
    )
    speaking = rows.where("license_file AND directory IS NOT NULL").groupBy(F.col("directory").alias("above")).agg(
        F.min(F.struct((-F.round("cosine", 9)).alias("order"), F.col("own_license").alias("name"))).alias("best")
    )
    directories = rows.where("directory IS NOT NULL").select("directory").distinct()
    climbing = directories.select("directory", F.posexplode(with_all_above(F.col("directory"))).alias("steps", "above"))
    nearest = climbing.join(speaking, "above").groupBy("directory").agg(F.min(F.struct("steps", "above", "best.name")).alias("near"))
    joined = null_safe_join(rows, nearest, ["directory"], "left")
    own = F.col("own_license").isNotNull()
    return joined.select(
        "path", "doc_id", "own_license", "cosine", "license_file",
        F.coalesce("own_license", "near.name").alias("license"),
        F.when(~own, F.col("near.above")).alias("inherited_from"),
    )
