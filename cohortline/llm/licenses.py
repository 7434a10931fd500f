"""Licence scans: a trained paragraph classifier, confirmed by template comparison.

Features are the word pairs and triples of the templates. A multinomial logistic
regression with a class for unknown text learns from the templates with words
left out at random, from unrelated lines about licences and permits, and from a
bounded sample of the corpus's own lines. A held-out part of these sets the
probability below which a prediction counts as unknown. A predicted family is
confirmed where the paragraph holds enough of the features of one of its
templates.

Every line with one of the marks (such as ``licen``) is judged by itself, and
where that leaves it unknown, joined with the nearest lines that hold words, so
that wrapped notices are whole again; a line without any is no licence notice by definition, and the marks
are looked for in whole texts before anything is split. Built-in functions and
JVM models only. Null and empty texts have no paragraphs; rows with equal id and
text are judged once. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"
VARIANTS = 24
SAMPLE_LINES = 2_000     # bound of the corpus's own lines to learn from
NEAR_LINES = 24          # lines with words joined on each side of a mark,
NEAR_CHARS = 2_000       # and signs of them, several times the longest template
CONFIRMED = 0.6          # share of a template's features that a paragraph must hold

# Marks, one of which every licence notice holds.
MARKS = ("licen", "copyright", "spdx", "public domain", "permission", "redistribut", "warrant")

# Notices of licence families, as they are commonly written.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "lgpl-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc0-1.0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
}

# Lines with marks that are no licence notices.
OTHERS = (
    "A driving licence must be renewed every ten years at the local office.",
    "The restaurant lost its liquor license after the inspection.",
    "Copyright reform was debated in parliament for the third time this year.",
    "He asked for permission to leave the table and was granted it.",
    "The warranty covers parts and labour for two years from the date of purchase.",
    "Police issued a warrant for the arrest of the suspect on Monday.",
    "The software license fee is due at the end of each quarter.",
    "All rights reserved. No part of this book may be copied without permission of the publisher.",
    "Wealth was redistributed among the villages after the reform.",
    "The band licensed the song to a film studio under a new contract.",
    "Licensed under contract to the city, the operator runs twelve bus lines.",
    "She holds a pilot license and a license to teach mathematics.",
    "The license terms of this product changed in version 2.0 of the manual.",
    "A general public licence to fish is free for residents.",
    "Copyright by the authors, used with permission of the museum.",
    "The poem entered the public domain seventy years after the death of its author.",
    "Our licensing team may be reached under the number on the back of the card.",
    "The common terms of the license agreement were released under pressure.",
)


def words(column: Column) -> Column:
    """Lower-case words of letters, digits and inner points or hyphens."""
    return F.regexp_extract_all(F.lower(column), F.lit(r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"), 0)


def features(of: str) -> Column:
    """Distinct word pairs and triples of an array column."""
    grams = lambda n: F.expr(
        f"CASE WHEN size({of}) >= {n} THEN transform(sequence(0, size({of}) - {n}), i -> array_join(slice({of}, i + 1, {n}), ' ')) ELSE array() END")
    return F.array_distinct(F.concat(grams(2), grams(3)))


def marked(column: Column) -> Column:
    low, found = F.lower(column), F.lit(False)
    for mark in MARKS:
        found |= F.contains(low, F.lit(mark))
    return found


def _template_rows(spark: SparkSession) -> DataFrame:
    """(template, family, words)"""
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    items = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(f).alias("family"), F.lit(t).alias("text")) for i, (f, t) in enumerate(rows)])
    return spark.range(1).select(F.explode(items).alias("t")).select("t.template", "t.family", words(F.col("t.text")).alias("words"))


def _own_lines(docs: DataFrame, text: str) -> DataFrame:
    """A bounded sample of lines without any mark, by hash of the text."""
    rows = docs.where(F.length(f"`{text}`") < 20_000).select(F.col(f"`{text}`").alias("text")).where(~marked(F.col("text")))
    few = rows.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_LINES // 10)
    return few.select(F.explode(F.slice(F.split("text", "\n"), 1, 10)).alias("line")).select(words(F.col("line")).alias("words"))


@dataclass
class Scanner:
    """Feature weights by class, and the templates that hold each feature: a table
    bounded by the templates, whatever the corpus."""

    classes: list[str]
    bias: list[float]
    table: DataFrame          # (feature, weights, templates)
    templates: list[tuple[str, int]]  # family and number of features
    least: float              # probability below which a prediction is unknown


def train(docs: DataFrame, text: str = "text") -> Scanner:
    spark = docs.sparkSession
    base = _template_rows(spark).withColumn("features", features("words"))
    classes = [UNKNOWN, *sorted(TEMPLATES)]
    seeds = F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("seed")
    known = base.select("family", "template", "words", seeds).withColumn(
        "words", F.expr("filter(words, (w, i) -> seed = 0 OR pmod(xxhash64(template, seed, i), 12) > 0)"))
    known = known.select("family", "words", "seed")
    other = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in OTHERS])).alias("line")).select(words(F.col("line")).alias("words"))
    other = other.unionByName(_own_lines(docs, text)).select(F.lit(UNKNOWN).alias("family"), "words", F.pmod(F.xxhash64("words"), F.lit(VARIANTS)).cast("int").alias("seed"))
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")).cast("double") - 1
    rows = known.unionByName(other).withColumn("features", features("words")).withColumn("label", index)
    vocabulary = sorted({f for r in base.select("features").collect() for f in r["features"]})  # the templates' own
    counter = CountVectorizerModel.from_vocabulary(vocabulary, "features", "x").setBinary(True)
    rows = counter.transform(rows).select("label", "x", "seed").persist()
    try:
        model = LogisticRegression(featuresCol="x", labelCol="label", family="multinomial", regParam=1e-3, maxIter=60).fit(rows.where("seed < 18"))
        judged = model.transform(rows.where("seed >= 18")).select("label", vector_to_array("probability").alias("p"))
        best = F.array_max(F.slice("p", 2, len(classes) - 1))
        edge = judged.agg(
            F.max(F.when(F.col("label") == 0, best)).alias("wrong"),
            F.min(F.when((F.col("label") > 0) & (F.array_position("p", F.array_max("p")) - 1 == F.col("label")), best)).alias("right")).first()
    finally:
        rows.unpersist()
    wrong, right = edge["wrong"] or 0.0, edge["right"] or 1.0
    weights = model.coefficientMatrix.toArray()
    of = {f: [] for f in vocabulary}
    sizes = []
    for r in base.select("template", "family", "features").orderBy("template").collect():
        sizes.append((r["family"], len(r["features"])))
        for f in r["features"]:
            of[f].append(r["template"])
    table = spark.createDataFrame(
        [(f, [float(w) for w in weights[:, i]], of[f]) for i, f in enumerate(vocabulary)], "feature string, weights array<double>, templates array<int>")
    return Scanner(classes, [float(b) for b in model.interceptVector], table, sizes, min(max((wrong + right) / 2, 0.3), 0.9))


def scan(docs: DataFrame, scanner: Scanner, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, line, family, probability, template, overlap) of every line with a mark;
    the family is unknown where it is not sure enough or not confirmed."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("row"), F.col(f"`{text}`").alias("text")).where(marked(F.col("text")))
    rows = rows.select("key", "row", F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("text"))), lambda x: x["text"].rlike(r"[\p{L}\p{N}]")).alias("lines"))
    rows = rows.select("key", "row", "lines", F.posexplode("lines").alias("at", "own")).where(marked(F.col("own.text")))
    before = F.expr(f"right(array_join(slice(lines, greatest(at - {NEAR_LINES}, 0) + 1, least(at, {NEAR_LINES})).text, ' '), {NEAR_CHARS})")
    after = F.expr(f"left(array_join(slice(lines, at + 2, {NEAR_LINES}).text, ' '), {NEAR_CHARS})")
    both = F.array(F.col("own.text"), F.concat_ws(" ", before, F.col("own.text"), after))
    rows = rows.select("key", "row", F.col("own.line").alias("line"), F.posexplode(both).alias("wide", "paragraph"))
    rows = rows.withColumn("words", words(F.col("paragraph")))
    grams = rows.select("key", "row", "line", "wide", F.explode_outer(features("words")).alias("feature"))
    found = grams.join(F.broadcast(scanner.table), "feature", "left")  # bounded by the templates
    sums = [F.coalesce(F.sum(F.get("weights", F.lit(k))), F.lit(0.0)).alias(f"z{k}") for k in range(len(scanner.classes))]
    held = [F.count(F.when(F.array_contains("templates", t), 1)).alias(f"h{t}") for t in range(len(scanner.templates))]
    one = found.dropDuplicates(["key", "row", "line", "wide", "feature"]).groupBy("key", "row", "line", "wide").agg(*sums, *held)
    one = one.withColumn("p", F.array(*[F.col(f"z{k}") + b for k, b in enumerate(scanner.bias)]))
    one = one.withColumn("p", F.expr("transform(p, x -> exp(x - array_max(p)))")).withColumn("p", F.expr("transform(p, x -> x / aggregate(p, 0D, (a, b) -> a + b))"))
    best = F.array_max(F.expr(f"transform(slice(p, 2, {len(scanner.classes) - 1}), (x, k) -> struct(x AS p, -k AS k))"))
    one = one.withColumn("best", best).withColumn("family", F.get(F.array(*[F.lit(c) for c in scanner.classes]), 1 - F.col("best.k")))
    hold = [F.when(F.col("family") == f, F.struct((F.col(f"h{t}") / n).alias("overlap"), F.lit(-t).alias("t"))) for t, (f, n) in enumerate(scanner.templates) if n]
    one = one.withColumn("near", F.array_max(F.array(*hold)))
    sure = (F.col("best.p") >= scanner.least) & (F.get("p", F.lit(0)) < F.col("best.p")) & (F.col("near.overlap") >= CONFIRMED)
    # The line by itself where it is sure, else with its neighbours where these are.
    one = one.withColumn("sure", F.coalesce(sure, F.lit(False)))
    fields = F.struct("sure", (-F.col("wide")).alias("narrow"), "family", "best", "near")
    one = one.groupBy("key", "row", "line").agg(F.max(fields).alias("judged")).select("key", "row", "line", "judged.*")
    sure = F.col("sure")
    return one.select(
        F.col("key").alias(key), F.col("line"), F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"),
        F.when(sure, F.col("best.p")).otherwise(1 - F.col("best.p")).alias("probability"),
        F.when(sure, -F.col("near.t")).alias("template"), F.coalesce(F.col("near.overlap"), F.lit(0.0)).alias("overlap"))
