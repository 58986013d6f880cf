"""License scan with MinHash over overlapping windows, in DataFrame operations only.

Words: ASCII lower-cased runs of a-z and 0-9.  Shingles are ``SHINGLE`` words; a
template of fewer words is one shingle of its own length.  Templates of like
length form a class; a class has windows of ``width`` words every ``stride``
words, so that a template that stands in a text lies wholly inside one of them.
A window and a template are compared if one of the class's bands (one MinHash
each) agrees; the number of bands is set so that a window which holds the
required share of a template's shingles is missed with a probability under
``MISS``.  Candidates are verified by exact shingle containment.

A text is tokenised once, and its shingles meet those of all templates in one
join, word for word.  Windows are built around these hits only and signed over
the shingles that their class knows: other shingles of a window can never agree
with a template, and leaving them out only raises the similarity that the bands
are set for.  The template side is broadcast while it has at most
``MAX_SHINGLES`` shingles; a larger one is shuffled.

Defined results: null and empty texts, and texts without words, match nothing;
templates without words are never found; repeated rows give their own rows
(results are per id and text); an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
MAX_SHINGLES = 500_000  # of all templates, while they are broadcast (about 50 MB)
MAX_TEMPLATE_BYTES = 64_000_000  # of a table of templates
PART = 128  # words of a part of a full licence text

# Texts of public licences and notices, and their SPDX names.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy,"
     " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("Apache-2.0-header", "Unless required by applicable law or agreed to in writing, software distributed under the License is"
     " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
     " Public License as published by the Free Software Foundation."),
)

# Standard headers and notices that are not part of the full texts.
HEADERS = (
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("LGPL", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-NC-ND-4.0", "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
     " disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT"),
    ("BSD-style", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
)


def parts_of(name: str, text: str, part: int = PART) -> list[tuple[str, str]]:
    """A full text as templates ``name#1``, ``name#2``, ... of at most ``part``
    words that together hold every word of it; the last one ends with the text."""
    w = words_of(text)
    starts = [*range(0, max(0, len(w) - part), part), max(0, len(w) - part)]
    return [(f"{name}#{n}", " ".join(w[s:s + part])) for n, s in enumerate(starts, 1)]


def known_templates() -> list[tuple[str, str]]:
    """Notices, standard headers, and the parts of the full texts that lie
    beside this module (file name: SPDX name)."""
    full = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return [*TEMPLATES, *[(f"{n}-header", t) for n, t in HEADERS], *[x for f in full for x in parts_of(f.stem, f.read_text("utf-8"))]]


@dataclass(frozen=True)
class LengthClass:
    """Templates of up to ``longest`` words that share windows."""

    shingle: int
    longest: int
    bands: int

    @property
    def stride(self) -> int:
        return max(1, self.longest // 4)

    @property
    def width(self) -> int:
        return self.longest + self.stride - 1


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def shingles_of(words: list[str], k: int) -> list[str]:
    return sorted({" ".join(words[i:i + k]) for i in range(len(words) - k + 1)})


def classes_of(templates, shingle: int, containment: float, miss: float) -> dict[LengthClass, list[tuple[str, list[str]]]]:
    grouped: dict[tuple[int, int], list[tuple[str, list[str]]]] = {}
    for name, text in templates:
        w = words_of(text)
        if w:
            k = min(shingle, len(w))
            longest = len(w) if k < shingle else 1 << (len(w) - 1).bit_length()
            grouped.setdefault((k, longest), []).append((name, shingles_of(w, k)))
    out = {}
    for (k, longest), own in grouped.items():
        shape = LengthClass(k, longest, 1)
        most = shape.width - k + 1
        least = min(need / (most + len(s) - need) for _, s in own for need in [math.ceil(containment * len(s))])
        out[LengthClass(k, longest, max(1, math.ceil(math.log(miss) / math.log(1 - least))) if least < 1 else 1)] = own
    return out


def _bands(n: Column, held: Column) -> Column:
    """One MinHash a band: the least shingle code under the band's own hash."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.struct(
        b.alias("b"), F.array_min(F.transform(held, lambda m: F.xxhash64(b, m))).alias("h")))


def _template_tables(spark: SparkSession, classes: list[tuple[LengthClass, list[tuple[str, list[str]]]]]) -> tuple[DataFrame, DataFrame, int]:
    """``(cls, k, stride, width, shingle, code)`` of every shingle of a class,
    ``(cls, bands, template, codes)``, and the number of rows of the former."""
    code = {x: n for n, x in enumerate(sorted({x for _, own in classes for _, ss in own for x in ss}))}
    shingles = [(c, shape.shingle, shape.stride, shape.width, x, code[x]) for c, (shape, own) in enumerate(classes)
                for x in sorted({x for _, ss in own for x in ss})]
    templates = [(c, shape.bands, name, [code[x] for x in ss]) for c, (shape, own) in enumerate(classes) for name, ss in own]
    return (spark.createDataFrame(shingles, "cls int, k int, stride int, width int, shingle string, code int"),
            spark.createDataFrame(templates, "cls int, bands int, template string, codes array<int>"), len(shingles))


def _hits(docs: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """``(id, version, pos, cls, k, stride, width, code)`` of every shingle of a
    template in a text; shingles meet by their first words, then word for word."""
    least, most = min(sizes), max(sizes)
    names = [f"w{j}" for j in range(most)]
    words = docs.select("id", "version", F.array_remove(F.split(F.lower(F.col("t")), "[^a-z0-9]+"), "").alias("words"))
    rows = words.select("id", "version", F.posexplode(F.arrays_zip(*[
        (F.slice("words", j + 1, F.size("words")) if j else F.col("words")).alias(n) for j, n in enumerate(names)])).alias("pos", "w"))
    rows = rows.select("id", "version", "pos", *[F.col("w")[n].alias(n) for n in names]).filter(F.col(names[least - 1]).isNotNull())
    first = F.split(F.col("shingle"), " ")
    known = known.withColumn("meet", F.xxhash64(*[F.get(first, j) for j in range(least)]))
    same = F.lit(False)
    for k in sizes:
        same = same | ((F.col("k") == k) & F.col(names[k - 1]).isNotNull() & (F.concat_ws(" ", *names[:k]) == F.col("shingle")))
    return (rows.withColumn("meet", F.xxhash64(*names[:least])).join(known, "meet").filter(same)
            .select("id", "version", "pos", "cls", "k", "stride", "width", "code"))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, shingle: int = SHINGLE,
         containment: float = CONTAINMENT, miss: float = MISS, max_shingles: int = MAX_SHINGLES) -> DataFrame:
    """``(doc_id, template, n_windows, containment, first_word)`` for every
    template found in a text: windows that hold it, the best share of its
    shingles, and the first word of the first such window.  Rows with the same
    id and text give one result.  ``templates`` are pairs of a name and a text,
    or a table of two such columns."""
    if isinstance(templates, DataFrame):
        named = templates.select(*[F.col(c).cast("string") for c in templates.columns[:2]])
        size = named.agg(F.coalesce(F.sum(F.octet_length(named.columns[1])), F.lit(0))).first()[0]
        if size > MAX_TEMPLATE_BYTES:
            raise ValueError(f"templates of {size} bytes; at most {MAX_TEMPLATE_BYTES} are scanned for at once")
        templates = [tuple(r) for r in named.dropna().collect()]
    classes = list(classes_of(templates, shingle, containment, miss).items())
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("version"), F.col(text_col).cast("string").alias("t"))
    if not classes:
        return base.limit(0).select(F.col("id").alias(id_col), F.lit("").alias("template"), F.lit(0).cast("long").alias("n_windows"),
                                    F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("first_word"))
    known, wanted, size = _template_tables(docs.sparkSession, classes)
    few = F.broadcast if size <= max_shingles else (lambda t: t)
    hits = _hits(base, few(known), sorted({shape.shingle for shape, _ in classes}))
    earliest = F.ceil(F.greatest(F.lit(0), F.col("pos") - F.col("width") + F.col("k")) / F.col("stride")).cast("int") * F.col("stride")
    windows = (hits.withColumn("start", F.explode(F.sequence(earliest, "pos", "stride")))
               .groupBy("id", "version", "cls", "start").agg(F.collect_set("code").alias("held")))
    signed = few(wanted.withColumn("band", F.explode(_bands(F.col("bands"), F.col("codes")))))
    bands = few(wanted.select("cls", "bands").distinct())
    met = windows.join(bands, "cls").withColumn("band", F.explode(_bands(F.col("bands"), F.col("held")))).drop("bands").join(signed, ["cls", "band"])
    share = F.size(F.array_intersect("held", "codes")) / F.size("codes")
    verified = met.select("id", "version", "template", "start", share.alias("share")).filter(F.col("share") >= containment)
    return (verified.groupBy("id", "version", "template").agg(
        F.count_distinct("start").alias("n_windows"), F.max("share").alias("containment"), F.min("start").cast("long").alias("first_word"))
        .select(F.col("id").alias(id_col), "template", "n_windows", "containment", "first_word"))
