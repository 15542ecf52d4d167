"""Licence scan: a trained paragraph classifier, confirmed against templates.

A sparse multinomial logistic regression over word n-grams tells the families
of licences, licences of no known family, and other text apart. It is trained
on notices of the families (fixed texts, whole and in parts) and on a bounded
sample of the corpus' own paragraphs. A first fit sees neither one notice of each
family nor a third of the paragraphs; on these the temperature of its
probabilities and the limit under which a family becomes unknown are chosen. The
second fit has all notices. A family counts only if the paragraph also shares enough
three-word shingles with one of the family's templates.

A paragraph is a run of neighbouring lines with a word that a weighted n-gram
has, so a licence text may be wrapped. Scoring is DataFrame functions only. The weights
are a small table, bounded by the notices; a line without such a word has
nothing but the intercepts, so it is settled by one pattern match. Paragraphs that
remain are scored once however often they occur.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import materialise

NONE, UNKNOWN = "none", "unknown"
#: So many documents at most give the paragraphs of other text for training, those of the smallest hash.
TRAIN_DOCUMENTS = 1000
#: Share of the paragraph's or of the template's shingles that must be common.
ALIKE = 0.4
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
#: Probabilities of which one becomes the least that makes a family known.
LIMITS = (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)

# Customary notices of licence families.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license. See LICENSE in the project root for license information.", "This project is licensed under the terms of the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "This software is released under the Apache 2.0 license."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.", "Released under the GNU GPL version 2 or later.", "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.", "Licensed under the GNU Lesser General Public License, version 2.1.", "Distributed under the LGPL version 3."],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "This program is distributed under the terms of the GNU Affero General Public License.", "Released under the AGPL version 3."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Released under the two-clause BSD license."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.", "Available under the Creative Commons Attribution license."],
    "CC-BY-SA": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0.", "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0.", "Available under the Creative Commons Attribution-NonCommercial license."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.", "This work is dedicated to the public domain under CC0 1.0 Universal.", "Released into the public domain under the CC0 license."],
    UNKNOWN: ["All rights reserved.", "Licensed under the terms of the vendor license agreement.", "Use of this material is subject to the license terms of its owner.", "Distributed under a custom license.", "This work is licensed under its own terms.", "Released under the company license, version 1.", "No part of this publication may be reproduced without written permission of the publisher."],
}
# Names by which a short notice calls a family.
SHORT = {
    "MIT": ["MIT"],
    "Apache-2.0": ["Apache-2.0", "Apache License 2.0"],
    "GPL": ["GPL-3.0", "GPL-2.0-or-later", "GPLv3"],
    "LGPL": ["LGPL-3.0", "LGPL-2.1"],
    "AGPL": ["AGPL-3.0"],
    "BSD": ["BSD-3-Clause", "BSD-2-Clause"],
    "MPL-2.0": ["MPL-2.0"],
    "CC-BY": ["CC-BY-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC0": ["CC0-1.0"],
    UNKNOWN: ["Proprietary"],
}
#: The forms of a short notice.
FORMS = ("SPDX-License-Identifier: {}", "License: {}", "{} License")
FAMILIES = [*TEMPLATES, NONE]
_WORDS = r"[a-z0-9]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_WORDS})"))


def _each(words: Column, body) -> Column:
    """``body`` of the words, which are found once however often it names them."""
    return F.transform(F.array(words), body)[0]


def _runs(words: Column, n: int) -> Column:
    whole = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, whole).otherwise(F.array().cast("array<string>"))


def _shingles(words: Column) -> Column:
    """Three-word windows over the words and two marks at either end, so that even a single word has some."""
    return _each(F.concat(F.array(F.lit("^"), F.lit("^")), words, F.array(F.lit("$"), F.lit("$"))), lambda w: F.array_distinct(_runs(w, 3)))


def _grams(words: Column) -> Column:
    """The distinct one- to three-word sequences."""
    return _each(words, lambda w: F.array_distinct(F.concat(*(_runs(w, n) for n in (1, 2, 3)))))


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from a literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _templates() -> list[tuple[str, str, bool]]:
    """Family, text and whether the first fit must not see it: one long notice and one name of each family."""
    rows = []
    for family, texts in TEMPLATES.items():
        rows += [(family, t, k == 1) for k, t in enumerate(texts)]
        rows += [(family, form.format(name), j == len(SHORT[family]) - 1 and j > 0) for j, name in enumerate(SHORT[family]) for form in FORMS]
    return rows


def _notices(spark: SparkSession) -> DataFrame:
    """Each template whole, and with words cut off at either end; what is held out is held out in all its parts."""
    rows = []
    for family, text, held_out in _templates():
        words = text.split()
        for a, b in ((0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1), (3, 0)):
            if (a, b) == (0, 0) or len(words) - a - b >= 3:
                rows.append({"family": family, "text": " ".join(words[a : len(words) - b]), "held_out": held_out})
    return _literal(spark, rows, "family string, text string, held_out boolean")


def one_of(words: list[str]) -> str:
    """A pattern for any of the words that branches letter by letter, as a long list of alternatives is slow to try."""
    trie: dict = {}
    for word in words:
        at = trie
        for c in word:
            at = at.setdefault(c, {})
        at[""] = {}

    def pattern(node: dict) -> str:
        parts = [re.escape(c) + pattern(node[c]) for c in sorted(node) if c]
        if not parts:
            return ""
        return (parts[0] if len(parts) == 1 and "" not in node else f"(?:{'|'.join(parts)})") + ("?" if "" in node else "")

    return pattern(trie)


class LicenceModel:
    """Sparse weights by n-gram and family, intercepts, the temperature, and the least probability of a known family."""

    def __init__(self, weights: list[dict], intercepts: dict[str, float], temperature: float = 1.0, sure: float = 0.5):
        self.weights, self.intercepts, self.temperature, self.sure = weights, intercepts, temperature, sure

    def trigger(self) -> str:
        """A pattern that matches wherever a weighted n-gram occurs."""
        return f"(?i)(?<![A-Za-z0-9]){one_of(sorted({w['gram'].split()[w['rare']] for w in self.weights}))}(?![A-Za-z0-9])" if self.weights else r"(?!)"


def _probabilities(scores: Column, temperature: float) -> Column:
    """Softmax over an array of struct(family, z)."""
    def powers(s: Column) -> Column:
        return _each(F.array_max(F.transform(s, lambda x: x["z"])), lambda top: F.transform(s, lambda x: F.struct(F.exp((x["z"] - top) / temperature).alias("p"), x["family"].alias("family"))))

    def shares(p: Column) -> Column:
        return _each(F.aggregate(p, F.lit(0.0), lambda a, x: a + x["p"]), lambda total: F.transform(p, lambda x: F.struct((x["p"] / total).alias("p"), x["family"].alias("family"))))

    return _each(_each(scores, powers), shares)


def _score(paragraphs: DataFrame, model: LicenceModel) -> DataFrame:
    """Adds ``scores``, the raw score of each family, to ``paragraph, words``."""
    spark = paragraphs.sparkSession
    weights = F.broadcast(_literal(spark, model.weights, "gram string, family string, weight double").groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("family", "weight"))).alias("by")))  # bounded by the vocabulary
    hits = paragraphs.select("paragraph", F.explode(_grams(F.col("words"))).alias("gram")).join(weights, "gram")
    sums = hits.groupBy("paragraph").agg(*(F.sum(F.coalesce(F.element_at("by", F.lit(f)), F.lit(0.0))).alias(f"s{k}") for k, f in enumerate(FAMILIES)))
    scores = F.array(*(F.struct(F.lit(f).alias("family"), (F.coalesce(f"s{k}", F.lit(0.0)) + model.intercepts.get(f, 0.0)).alias("z")) for k, f in enumerate(FAMILIES)))
    return paragraphs.join(sums, "paragraph", "left").select(*paragraphs.columns, scores.alias("scores"))


def _fit(rows: DataFrame) -> LicenceModel:
    """A fit on ``family, grams``; the features are the n-grams of at least two notices that other text hardly has, with a word that it hardly has."""
    usual = rows.where(F.col("family") == NONE).count()
    seen = rows.select((F.col("family") == NONE).alias("other"), F.explode("grams").alias("gram")).groupBy("gram").agg(F.sum(F.col("other").cast("long")).alias("k"), F.sum((~F.col("other")).cast("long")).alias("n"))
    seen = seen.where("n > 0").orderBy(F.desc("n"), "gram").collect()  # bounded by the notices
    common, most = {r.gram: r.k for r in seen if " " not in r.gram}, 0.001 * usual
    terms = [r.gram for r in seen if r.n >= 2 and r.k <= most and min(common[w] for w in r.gram.split()) <= most]
    code = F.array(*(F.lit(f) for f in FAMILIES))
    shares = F.when(F.col("family") == NONE, 1.0).otherwise(F.lit(usual / max(1, len(FAMILIES)) / 20.0 + 1.0))
    vectors = CountVectorizerModel.from_vocabulary(terms, "grams", "features").setBinary(True)
    fitted = LogisticRegression(labelCol="label", weightCol="w", regParam=2e-4, elasticNetParam=0.5, maxIter=50, family="multinomial", standardization=False).fit(
        vectors.transform(rows).select("features", (F.array_position(code, F.col("family")) - 1).cast("double").alias("label"), shares.alias("w"))
    )
    matrix = fitted.coefficientMatrix.toArray()
    weights = []
    for j, gram in enumerate(terms):
        words = gram.split()
        least = min(range(len(words)), key=lambda i: common[words[i]])
        weights += [{"gram": gram, "family": f, "weight": float(matrix[k, j]), "rare": least} for k, f in enumerate(FAMILIES) if k < len(matrix) and abs(matrix[k, j]) > 1e-3]
    return LicenceModel(weights, {f: float(fitted.interceptVector[k]) for k, f in enumerate(FAMILIES) if k < len(matrix)})


def _calibrate(checked: DataFrame, model: LicenceModel) -> tuple[float, float]:
    """The temperature of the least loss on ``paragraph, family``, and the limit that then takes most licences for what they are."""
    scored = materialise(_score(checked.select("paragraph", "family", _words(F.col("paragraph")).alias("words")), model), "checked")
    losses = scored.agg(*(F.avg(-F.log(F.greatest(F.lit(1e-12), F.filter(_probabilities(F.col("scores"), t), lambda s: s["family"] == F.col("family"))[0]["p"]))).alias(f"t{k}") for k, t in enumerate(TEMPERATURES))).first()
    loss = [x if x is not None and not math.isnan(x) else math.inf for x in losses]
    temperature = TEMPERATURES[loss.index(min(loss))]
    best = F.array_max(_probabilities(F.col("scores"), temperature))
    named = scored.where(F.col("family") != NONE).select("family", best.alias("best"))
    right = named.agg(*(F.sum((F.when((F.col("best.p") >= x) & (F.col("best.family") != NONE), F.col("best.family")).otherwise(UNKNOWN) == F.col("family")).cast("long")).alias(f"l{k}") for k, x in enumerate(LIMITS))).first()
    hits = [x or 0 for x in right]
    return temperature, LIMITS[hits.index(max(hits))]


def fit_licences(documents: DataFrame, most: int = TRAIN_DOCUMENTS) -> LicenceModel:
    """Trains on the notices and on the paragraphs of ``most`` documents at most, those of the smallest hash of doc_id and text."""
    spark = documents.sparkSession
    hashed = documents.select("text", F.xxhash64("doc_id", "text").alias("h"))
    every = max(1, documents.count() // (2 * most))  # about twice as many are looked at as are taken
    chosen = hashed.where(F.pmod("h", F.lit(every).cast("long")) == 0).orderBy("h", "text").limit(most).select("text")
    shared = F.from_json(F.lit(json.dumps(sorted({" ".join(w[i : i + 3]) for _, t, _ in _templates() for w in [re.findall(_WORDS, t.lower())] for i in range(max(1, len(w) - 2))}))), "array<string>")
    other = chosen.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("text")).groupBy("text").count().select("text", _words(F.col("text")).alias("words")).where(F.size("words") > 0)
    other = other.where(~F.arrays_overlap(_each(F.col("words"), lambda w: F.when(F.size(w) < 3, F.array(F.array_join(w, " "))).otherwise(_runs(w, 3))), shared))
    other = other.select(F.lit(NONE).alias("family"), "text", (F.pmod(F.xxhash64("text"), F.lit(3)) == 2).alias("held_out"))
    rows = materialise(_notices(spark).unionByName(other).select("*", _grams(_words(F.col("text"))).alias("grams")).coalesce(2), "training")  # a bounded sample
    checked = rows.where("held_out").select(F.col("text").alias("paragraph"), "family").groupBy("paragraph").agg(F.first("family").alias("family"))
    temperature, sure = _calibrate(checked, _fit(rows.where(~F.col("held_out"))))
    model = _fit(rows)
    model.temperature, model.sure = temperature, sure
    return model


def _paragraphs(text: Column, pattern: str) -> Column:
    """Runs of neighbouring lines that match, each as one line; null if none does."""
    kept = F.transform(F.split(text, "\n"), lambda x: F.when(x.rlike(pattern), F.trim(F.regexp_replace(x, r"\s+", " "))).otherwise(""))
    runs = F.filter(F.split(F.array_join(kept, "\n"), "\n{2,}"), lambda x: x != "")
    return F.when(text.rlike(pattern), F.transform(runs, lambda x: F.trim(F.translate(x, "\n", " "))))


def scan_licences(documents: DataFrame, model: LicenceModel) -> DataFrame:
    """The licence of every document: one row for each input row.

    Returns ``doc_id``, ``license`` (a family, ``unknown`` for a licence of no
    confirmed family, ``none``), ``probability`` of the paragraph it was found in,
    ``similarity`` to the nearest template of the family and ``n_paragraphs``, the
    number of licence paragraphs. Paragraphs are runs of neighbouring lines with a
    word of a licence. Known families go before unknown ones, then the more probable;
    ties go to the first by name. A null, empty or blank text
    has no licence. Repeated rows get a row each; an empty table gives an empty
    result; further columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), _paragraphs(F.col("text"), model.trigger()).alias("paragraphs"))
    rows = materialise(rows, "paragraphs")  # row numbers stay as written
    found = rows.select("row", F.explode("paragraphs").alias("paragraph"))
    distinct = found.select("paragraph").distinct().withColumn("words", _words(F.col("paragraph")))
    scored = _score(distinct, model).withColumn("best", F.array_max(_probabilities(F.col("scores"), model.temperature)))
    scored = scored.select("paragraph", F.col("best.family").alias("family"), F.col("best.p").alias("p"), _shingles(F.col("words")).alias("own")).where(F.col("family") != NONE)
    shared = F.size(F.array_intersect("own", "shingles"))
    likeness = F.greatest(shared / F.size("own"), shared / F.size("shingles"))
    templates = _literal(spark, [{"family": f, "template": t} for f, t, _ in _templates()], "family string, template string").select("family", _shingles(_words(F.col("template"))).alias("shingles"))
    nearest = scored.join(F.broadcast(templates), "family").groupBy("paragraph").agg(F.max(likeness).alias("similarity"))  # the fixed templates
    sure = (F.col("p") >= model.sure) & (F.coalesce("similarity", F.lit(0.0)) >= ALIKE) & (F.col("family") != UNKNOWN)
    judged = scored.join(nearest, "paragraph", "left").select("paragraph", F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("license"), "p", F.coalesce("similarity", F.lit(0.0)).alias("similarity"), sure.alias("sure"))
    judged = materialise(judged, "judged")
    # with equal probabilities the first family by name, then the first paragraph
    order = F.struct((~F.col("sure")).alias("doubt"), (-F.col("p")).alias("doubts"), "license", "paragraph", "similarity")
    hits = found.join(judged, "paragraph").groupBy("row").agg(F.min(order).alias("best"), F.count("*").alias("n"))
    out = rows.select("row", "doc_id").join(hits, "row", "left")
    return out.select("doc_id", F.coalesce("best.license", F.lit(NONE)).alias("license"), (-F.col("best.doubts")).alias("probability"), F.col("best.similarity").alias("similarity"), F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"))
