"""Licence scans: a trained paragraph classifier over word n-grams, confirmed by the templates.

Notices of each family, cut and set in prose, are the examples of the families; all paragraphs of the corpus are
those of the unknown class, bar the ones that look like a notice. Paragraphs that share the same n-grams with notices
are counted first, so that training takes one weighted row for them. A logistic regression with an L1 penalty over
words and word pairs gives sparse weights. Scoring explodes the hashed n-grams of all paragraphs, joins them with
the weights, whose number is bounded by the notices', and adds up per paragraph: the partial sums leave one row
per paragraph for the shuffle. A family is accepted above a threshold calibrated on held-out paragraphs of the
corpus, and confirmed where the paragraph shares enough words with one of the family's notices.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.llm.common import checkpointed, let, read

UNKNOWN = "unknown"
CORPUS_WEIGHT = 4_000
FALSE_SHARE = 0.001
STEPS = 10_000
SIMILAR = 0.6
LOOKS_LIKE = 0.5
PROSE = 20

# Customary notices of the licence families.
NOTICES = {
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Affero General Public License, version 3.",
        "This work is licensed under the GNU Affero General Public License v3.0.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Except where otherwise noted, content on this site is licensed under CC BY 3.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under CC BY-NC-SA 4.0 for non-commercial use.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ],
}
FAMILIES = sorted(NOTICES)


def terms(text: Column) -> Column:
    """Lower-case words of letters and digits; ``2.0`` and ``cc-by`` are two words each."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def pairs(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))


def grams(text: Column) -> Column:
    """Distinct words and word pairs."""
    return let(terms(text), lambda w: F.array_distinct(F.when(F.size(w) < 2, w).otherwise(F.concat(w, pairs(w)))))


def hashed_grams(text: Column) -> Column:
    """Hashes of ``grams``, without building the pairs' texts."""

    def of(w: Column) -> Column:
        single = F.transform(w, lambda x: F.xxhash64(x, F.lit("")))
        double = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))
        return F.array_distinct(F.when(F.size(w) < 2, single).otherwise(F.concat(single, double)))

    return let(terms(text), of)


def notices(spark: SparkSession) -> DataFrame:
    """``family, notice``."""
    rows = json.dumps([{"family": f, "notice": n} for f in FAMILIES for n in NOTICES[f]])
    parsed = spark.range(1).select(F.explode(F.from_json(F.lit(rows), "array<struct<family:string,notice:string>>")).alias("r"))
    return parsed.select("r.*")


def distinct_words(families: list[str]) -> list[list[str]]:
    """The distinct words of each notice of the families."""
    return [sorted(set(re.findall(r"[^\W_]+", n.lower()))) for f in families for n in NOTICES[f]]


def known_words(families: list[str]) -> Column:
    """Constant: the distinct words of each notice of the families."""
    return F.from_json(F.lit(json.dumps(distinct_words(families))), "array<array<string>>")


def nearest_of(words: Column, family: str) -> Column:
    """Greatest overlap of a paragraph's words with a notice of the family."""
    return let(words, lambda w: F.array_max(F.transform(known_words([family]), lambda k: overlap(w, k))))


def overlap(a: Column, b: Column) -> Column:
    """Shared words over those of the shorter of two lists of distinct words."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, paragraph, line`` of the lines that hold a word; null texts have none."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    lines = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return lines.where(F.col("line").rlike(r"[\p{L}\p{N}]"))


def notice_grams(spark: SparkSession) -> list[tuple[str, int]]:
    """The n-grams of all notices in order, each with its hash; bounded by the notices above."""
    found = notices(spark).select(F.explode(grams(F.col("notice"))).alias("g")).distinct()
    pair = F.split("g", " ")
    return sorted((r.g, r.h) for r in found.select("g", F.xxhash64(pair[0], F.coalesce(F.get(pair, F.lit(1)), F.lit(""))).alias("h")).collect())


def shared_grams(text: Column, known: list[tuple[str, int]]) -> Column:
    """The hashes of a text's n-grams that a notice has, in order."""
    return F.sort_array(F.array_intersect(hashed_grams(text), F.lit([h for _, h in known])))


def corpus_vectors(docs: DataFrame, known: list[tuple[str, int]]) -> DataFrame:
    """``grams, held, n, least``: all lines of all documents, counted by the n-grams they share with notices.

    Lines like a notice are left out. ``least`` is the least hash of such lines. Equal lines are all held out or none.
    """
    hashes = dict(known)
    families = [[hashes[x] for x in words] for words in distinct_words(FAMILIES)]
    longest = max(len(words) for words in families)
    lines = paragraphs(docs).select("line", F.xxhash64("line").alias("h"))
    # More words than the longest notice has change no overlap.
    size = F.least(F.size(F.array_distinct(terms(F.col("line")))), F.lit(longest))
    keys = [shared_grams(F.col("line"), known).alias("grams"), size.alias("words"), (F.pmod("h", F.lit(3)) == 0).alias("held")]
    counted = lines.select(*keys, "h").groupBy("grams", "words", "held").agg(F.count("*").alias("n"), F.min("h").alias("least"))
    # Written first: the filter below would otherwise be evaluated for every line, with the n-grams for every notice.
    counted = checkpointed(counted)
    notice = F.from_json(F.lit(json.dumps(families)), "array<array<bigint>>")

    def near(k: Column) -> Column:
        return F.size(F.array_intersect("grams", k)) / F.least(F.col("words"), F.size(k)) >= LOOKS_LIKE

    like = (F.col("words") >= 3) & F.exists(notice, near)
    return counted.where(~like).groupBy("grams", "held").agg(F.sum("n").alias("n"), F.min("least").alias("least"))


def examples(docs: DataFrame, known: list[tuple[str, int]]) -> DataFrame:
    """``grams, family, held, n``: notices whole, cut and set in prose, and all lines of the corpus that aren't like one.

    ``grams`` are those of ``known``, and ``n`` is the number of lines that share these; nothing is sampled.
    """
    spark = docs.sparkSession
    given = notices(spark)
    zeros = checkpointed(corpus_vectors(docs, known).sortWithinPartitions("grams", "held"))

    def part(first: float, last: float) -> Column:
        w = F.split("notice", " ")
        low = F.floor(F.size(w) * first).cast("int")
        return F.array_join(F.slice(w, low + 1, F.greatest(F.ceil(F.size(w) * last).cast("int") - low, F.lit(1))), " ")

    whole = [F.col("notice"), F.concat(F.lit("This file: "), F.col("notice")), F.concat(F.col("notice"), F.lit(" All rights reserved."))]
    cut = [part(a, b) for a, b in ((0.0, 0.7), (0.2, 1.0), (0.1, 0.9))]
    # Cuts of short notices lose the family's name.
    variants = F.when(F.size(F.split("notice", " ")) >= 8, F.array(*whole, *cut)).otherwise(F.array(*whole))
    ones = given.select("family", F.explode(variants).alias("line"))
    # The prose around a notice: lines of the lowest hashes.
    least = [r.least for r in zeros.where("not held").orderBy("least").select("least").take(PROSE)]
    if least:
        told = paragraphs(docs).where(F.xxhash64("line").isin(least)).select(F.substring("line", 1, 60).alias("prose")).distinct()
        prose = [r.prose for r in told.orderBy("prose").collect()]
        before = F.get(F.array(*[F.lit(x) for x in prose]), F.pmod(F.xxhash64("notice"), F.lit(len(prose))).cast("int"))
        ones = ones.union(given.select("family", F.concat_ws(" ", before, F.col("notice"))))
    ones = ones.select(shared_grams(F.col("line"), known).alias("grams"), "family", F.lit(False).alias("held"), F.lit(1).cast("long").alias("n"))
    return checkpointed(ones.union(zeros.select("grams", F.lit(UNKNOWN), "held", "n")))


class Classifier:
    """Weights of the n-grams, a row of ``UNKNOWN`` and the families each, and the threshold of acceptance.

    Both come from all lines. Lines of the corpus that share the same n-grams are one row with their number as weight,
    and all of them together weigh ``CORPUS_WEIGHT`` at most, so that a large corpus doesn't drown the notices.
    """

    def __init__(self, docs: DataFrame) -> None:
        self.spark = docs.sparkSession
        known = notice_grams(self.spark)
        rows = examples(docs, known)
        self.vocabulary = [g for g, _ in known]
        self.classes = [UNKNOWN, *FAMILIES]
        index = F.array_position(F.array(*[F.lit(c) for c in self.classes]), F.col("family")).cast("double") - 1
        counted = CountVectorizerModel.from_vocabulary([str(h) for _, h in known], "grams", "counts", binary=True)
        shown = counted.transform(rows.select(F.col("grams").cast("array<string>").alias("grams"), index.alias("label"), "held", "n"))
        scaled = Normalizer(inputCol="counts", outputCol="x", p=2.0).transform(shown)
        sizes = {r.held: r.n for r in shown.where("label = 0").groupBy("held").agg(F.sum("n").alias("n")).collect()}
        share = min(1.0, CORPUS_WEIGHT / sizes.get(False, 1))
        fitted = scaled.where("not held").withColumn("weight", F.when(F.col("label") == 0, F.col("n") * share).otherwise(4.0))
        fit = LogisticRegression(
            featuresCol="x", labelCol="label", weightCol="weight", family="multinomial", regParam=0.0005, elasticNetParam=0.5, standardization=False, maxIter=60
        )
        self.model: LogisticRegressionModel = fit.fit(fitted)
        self.threshold = 0.5
        if sizes.get(True):
            judged = self.model.transform(scaled.where("held")).select("n", F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES))).alias("p"))
            bins = judged.where("p >= 0.5").groupBy(F.floor(F.col("p") * STEPS).alias("bin")).agg(F.sum("n").alias("n"))
            self.threshold = self.calibrated({r.bin: r.n for r in bins.collect()}, int(sizes[True] * FALSE_SHARE))

    @staticmethod
    def calibrated(bins: dict[int, int], allowed: int) -> float:
        """The least threshold from 0.5 to 0.9, in steps, that at most ``allowed`` held-out lines reach."""
        reached, least = 0, STEPS // 2
        for k in sorted(bins, reverse=True):
            reached += bins[k]
            if reached > allowed:
                least = k + 1
                break
        return min(least / STEPS, 0.9)

    def weights(self) -> DataFrame:
        """``gram, w``: the hash of an n-gram and its weights per class; n-grams without weight are kept, they count
        for the length of the vector."""
        matrix = self.model.coefficientMatrix.toArray()
        rows = [{"a": g.partition(" ")[0], "b": g.partition(" ")[2], "w": [float(x) for x in matrix[:, k]]} for k, g in enumerate(self.vocabulary)]
        parsed = self.spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<a:string,b:string,w:array<double>>>")).alias("r"))
        return parsed.select(F.xxhash64("r.a", "r.b").alias("gram"), *[F.get("r.w", F.lit(k)).alias(f"w{k}") for k in range(len(self.classes))])

    def scored(self, lines: DataFrame) -> DataFrame:
        """Paragraphs that share an n-gram with a notice, with their best family and its probability.

        The others have the score of no n-gram, which is the unknown class's by its intercept.
        """
        keys = ["doc_id", "text_hash", "paragraph"]
        exploded = lines.select(*keys, F.explode(hashed_grams(F.col("line"))).alias("gram"))
        met = exploded.join(F.broadcast(self.weights()), "gram")
        count = len(self.classes)
        sums = met.groupBy(*keys).agg(*[F.sum(f"w{k}").alias(f"w{k}") for k in range(count)], F.count("*").alias("n"))
        intercepts = [float(x) for x in self.model.interceptVector]
        z = F.array(*[F.col(f"w{k}") / F.sqrt("n") + F.lit(intercepts[k]) for k in range(count)])
        best = F.array_max(F.transform(F.slice("z", 2, count - 1), lambda x: x))
        total = F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("z")))
        chosen = sums.select(*keys, z.alias("z")).select(*keys, "z", best.alias("best"))
        family = F.get(F.array(*[F.lit(f) for f in FAMILIES]), (F.array_position(F.slice("z", 2, count - 1), F.col("best")) - 1).cast("int"))
        return chosen.select(*keys, family.alias("family"), (F.exp(F.col("best") - F.array_max("z")) / total).alias("probability"))


def scan(docs: DataFrame) -> DataFrame:
    """A row per accepted paragraph: ``doc_id, text_hash, paragraph`` (line number from 0)``, line, family,
    probability, similarity, confirmed``.

    Documents without such a paragraph, null and empty texts give no row. Repeated rows of one id and text are
    one document. Without any line in the corpus nothing is accepted.
    """
    lines = paragraphs(docs)
    judge = Classifier(docs)
    found = checkpointed(judge.scored(lines).where(F.col("probability") >= judge.threshold))
    few = found.count() <= 1_000_000
    hits = F.broadcast(found) if few else found
    texts = lines.join(hits, (lines.doc_id.eqNullSafe(found.doc_id)) & (lines.text_hash == found.text_hash) & (lines.paragraph == found.paragraph))
    texts = texts.select(lines.doc_id, lines.text_hash, lines.paragraph, "line", "family", "probability").dropDuplicates(["doc_id", "text_hash", "paragraph"])
    words = F.array_distinct(terms(F.col("line")))
    nearest = F.lit(None).cast("double")
    for family in FAMILIES:
        nearest = F.when(F.col("family") == family, nearest_of(words, family)).otherwise(nearest)
    out = texts.withColumn("similarity", nearest)
    return out.withColumn("confirmed", F.col("similarity") >= SIMILAR)


def licences(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, ``licences`` (confirmed families in order, joined by commas; empty if none),
    ``n_confirmed``, ``n_unconfirmed`` and ``probability``, the highest of its paragraphs or 0."""
    found = scan(docs)
    per = found.groupBy("doc_id", "text_hash").agg(
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("licences"),
        F.sum(F.col("confirmed").cast("long")).alias("n_confirmed"),
        F.sum((~F.col("confirmed")).cast("long")).alias("n_unconfirmed"),
        F.max("probability").alias("probability"),
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"))
    joined = rows.join(per, rows.doc_id.eqNullSafe(per.doc_id) & (rows.text_hash == per.text_hash), "left")
    empty = {"licences": "", "n_confirmed": 0, "n_unconfirmed": 0, "probability": 0.0}
    return joined.select(rows.doc_id, *empty).fillna(empty)


def op1_paragraph_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(read(spark, sf_dir, "documents"))
