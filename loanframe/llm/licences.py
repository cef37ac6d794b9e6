"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a run of lines up to a line without letters or digits; line breaks and comment marks part words like
spaces.  What is classified are its lines one by one and, where it has several lines or many words, overlapping windows
of its words: every run of ``WINDOW - STEP + 1`` words, which is longer than any template, stands in one window.  Sparse
word uni- and bigrams, hashed, go into a multinomial logistic regression over licence families and the class
``unknown``.  Families are learned from variants of their templates, ``unknown``
from a bounded sample of the table's paragraphs.  A family's threshold is set on held-back examples so that the wanted
share of what passes is right; whatever is below it is unknown.  A prediction counts when enough of some template's
word pairs, rarer wording included, stand in the line or window.  Without some of its rarer words no template can have
enough pairs, so only lines and windows with one of these words are looked at.  Where an end is cut off that would tell
families apart, the words around decide: the other family must not be as alike here and more alike with them.  The lines of a hit are those that its
template's word pairs stand in; hits of one family that share a line are one, but every line confirmed alone counts.

Everything runs as column expressions and ``pyspark.ml`` stages.

Defined results: a text that is null, empty or has no hit has zero hits and an empty list; repeated rows are scanned
each; an empty table gives an empty one; a sample without other paragraphs leaves the templates against each other;
only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.llm.common import hash_share, stored

# fixed values: notices as licences are usually named in documents, by family
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Use of this source code is governed by a BSD-style license."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "MIT licensed"),
    ("MIT", "Licensed under MIT"),
    ("MIT", "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability"),
    ("Apache-2.0", "Apache 2.0 licensed"),
    ("Apache-2.0", "Distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("GPL-3.0", "Licensed under GPLv3"),
    ("GPL-3.0", "Licensed under the GPLv3"),
    ("GPL-3.0", "Licensed under the GPL version 3"),
    ("GPL-2.0", "Licensed under GPLv2"),
    ("GPL-2.0", "Licensed under the GPLv2"),
    ("GPL-2.0", "Licensed under the GPL version 2"),
    ("BSD", "BSD licensed"),
    ("BSD", "Licensed under the 3-clause BSD license"),
    ("BSD", "This software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC", "Licensed under the ISC License"),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0"),
    *[(family, f"SPDX-License-Identifier: {tag}") for family, tags in (
        ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL-3.0", "GPL-3.0 GPL-3.0-only GPL-3.0-or-later"), ("GPL-2.0", "GPL-2.0 GPL-2.0-only GPL-2.0-or-later"),
        ("LGPL", "LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later"), ("AGPL-3.0", "AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later"),
        ("BSD", "BSD-2-Clause BSD-3-Clause"), ("MPL-2.0", "MPL-2.0"), ("ISC", "ISC"), ("Zlib", "Zlib"), ("BSL-1.0", "BSL-1.0"), ("EPL-2.0", "EPL-2.0"),
        ("CC-BY", "CC-BY-4.0"), ("CC-BY-SA", "CC-BY-SA-4.0"), ("CC-BY-NC", "CC-BY-NC-4.0"), ("CC0", "CC0-1.0"), ("Unlicense", "Unlicense")) for tag in tags.split()],
]
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *dict.fromkeys(f for f, _ in TEMPLATES)]
FEATURES = 1 << 13
VARIANTS = 40          # of each template
AT_MOST = 6_000        # paragraphs of the table that the class unknown is learned from
PRECISION = 0.98       # wanted of what passes a family's threshold
ALIKE = 0.6            # share of a template's word pairs that confirms a prediction
WINDOW = 40            # words classified together
STEP = 16              # words from one window to the next
LONGEST = 400          # words of a paragraph that the class unknown is learned from; all words are classified
FIT_PARTS = 1          # partitions of the examples, whose number is bounded: every step of the fit sends the driver all gradients of each


def words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit("[\\p{L}\\p{N}]+(?:[-.][\\p{L}\\p{N}]+)*+"), F.lit(0))


def _pairs(of: Column) -> Column:
    """Neighbouring words joined; empty for a single word."""
    def pair(i: Column) -> Column:
        return F.concat_ws(" ", of[i - 1], of[i])

    return F.when(F.size(of) > 1, F.transform(F.sequence(F.lit(1), F.size(of) - 1), pair)).otherwise(F.array().cast("array<string>"))


def _terms(rows: DataFrame) -> DataFrame:
    """Adds the hashed terms of the column ``words``."""
    rows = rows.withColumn("terms", F.concat("words", _pairs(F.col("words"))))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="terms", outputCol="features").transform(rows)


def lines_of(docs: DataFrame) -> DataFrame:
    """(paragraph) of every line that has a letter."""
    rows = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\\R")).alias("paragraph"))
    return rows.filter(F.col("paragraph").rlike("\\p{L}"))


def units(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, alone, words, at, wide): lines, and windows of paragraphs, that a template's rarer word stands in.

    ``at`` has the line of each word, ``wide`` the words around as well, ``alone`` tells the lines.  A paragraph without any has a row of nulls, and so has
    a text without paragraphs.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.split(F.coalesce("text", F.lit("")), "\\R").alias("lines"))
    ends = F.concat(F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: ~F.col("lines")[i].rlike("[\\p{L}\\p{N}]")), F.array(F.size("lines")))
    rows = rows.withColumn("ends", ends)
    each = F.transform("ends", lambda end, k: F.struct(F.when(k > 0, F.col("ends")[k - 1] + 1).otherwise(0).alias("start"), end.alias("end")))
    rows = rows.withColumn("part", F.explode_outer(F.filter(each, lambda x: x["end"] > x["start"])))
    rows = rows.select("rid", "doc_id", "part.start", F.slice("lines", F.col("part.start") + 1, F.col("part.end") - F.col("part.start")).alias("lines"))
    rows = rows.withColumn("by_line", F.transform("lines", lambda x: words(F.regexp_replace(x, "^\\s*(?i:dnl|rem)\\s", " "))))
    rows = rows.select("rid", "doc_id", "start", "by_line", F.flatten("by_line").alias("all"), F.flatten(
        F.transform("by_line", lambda w, i: F.array_repeat(F.col("start") + i, F.size(w)))).alias("at"))
    beside = lambda i: F.coalesce(F.get("by_line", i), F.array().cast("array<string>"))

    def line(w: Column, i: Column) -> Column:
        before = F.reverse(F.slice(F.reverse(beside(i - 1)), 1, F.lit(STEP)))
        return F.struct(F.lit(True).alias("alone"), w.alias("words"), F.array_repeat(F.col("start") + i, F.size(w)).alias("at"),
                        F.concat(before, w, F.slice(beside(i + 1), 1, F.lit(STEP))).alias("wide"))

    def window(i: Column) -> Column:
        wide = F.slice("all", F.greatest(F.lit(1), i + 1 - STEP), F.lit(WINDOW + 2 * STEP))
        return F.struct(F.lit(False).alias("alone"), F.slice("all", i + 1, F.lit(WINDOW)).alias("words"), F.slice("at", i + 1, F.lit(WINDOW)).alias("at"), wide.alias("wide"))

    starts = F.when((F.size("by_line") > 1) | (F.size("all") > WINDOW), F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("all") - WINDOW + STEP - 1), F.lit(STEP)))
    both = F.concat(F.transform("by_line", line), F.transform(F.coalesce(starts, F.array().cast("array<int>")), window))
    telling = F.array(*[F.lit(w) for w in sorted(_telling())])
    fine = F.filter(both, lambda u: F.arrays_overlap(u["words"], telling))
    return rows.select("rid", "doc_id", F.explode_outer(fine).alias("u")).select("rid", "doc_id", "u.*")


def _telling() -> set[str]:
    """Words without which the rest of no template, longest words first, has the share ALIKE of its pairs."""
    found = set()
    for w in (_plain_words(t) for _, t in TEMPLATES):
        pairs, n = set(zip(w, w[1:])), len(set(zip(w, w[1:])))
        for word in sorted(set(w), key=lambda x: (x not in found, -len(x), x)):
            if len(pairs) < ALIKE * n:
                break
            found.add(word)
            pairs = {p for p in pairs if word not in p}
    return found


def _templates(spark: SparkSession) -> DataFrame:
    each = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in TEMPLATES])
    return spark.range(1).select(F.explode(each).alias("t")).select("t.family", words(F.col("t.text")).alias("words"))


def _variants(spark: SparkSession, others: DataFrame) -> DataFrame:
    """(label, words): templates as they are, with words left out, and between words of other paragraphs; and those paragraphs."""
    numbered = _templates(spark).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    draw = lambda x, i: F.pmod(F.xxhash64(x, i, F.col("v")), F.lit(100))
    kept = F.when(F.col("v") < 4, F.col("words")).otherwise(F.filter("words", lambda x, i: draw(x, i) >= 8))
    known = numbered.select(F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")).cast("int").alias("label"), kept.alias("words"), "v")
    around = others.limit(VARIANTS).select(F.slice("words", 1, 12).alias("extra"), (F.row_number().over(_by_hash()) - 1).alias("k"))
    mixed = known.filter("v % 2 = 1").join(F.broadcast(around), F.col("v") == F.col("k"))
    around_it = F.concat(F.slice("extra", 1, 6), "words", F.slice("extra", 7, 12))
    mixed = mixed.select("label", F.when(F.col("v") % 4 == 1, F.concat("extra", "words")).when(
        F.col("v") % 8 == 3, around_it).otherwise(F.concat("words", "extra")).alias("words"))
    rows = known.select("label", "words").unionByName(mixed)
    return rows.withColumn("label", F.col("label") - 1).unionByName(others.select(F.lit(0).alias("label"), "words"))


def _by_hash():
    from pyspark.sql import Window

    return Window.orderBy(F.xxhash64("words"))


def fit(lines: DataFrame, at_most: int = AT_MOST, precision: float = PRECISION) -> tuple[LogisticRegressionModel, list[float]]:
    """The model and the threshold of each family."""
    spark = lines.sparkSession
    usable = lines
    n = usable.count()
    draw = hash_share("paragraph", seed=53)
    # paragraphs that look like a template are no examples of anything else
    drawn = usable.filter(draw < 1.2 * at_most / max(1, n))
    # the last paragraph drawn is found on numbers alone; equal ones count once, so that what is kept is bounded
    last = drawn.select(draw.alias("turn")).orderBy("turn").limit(at_most).agg(F.max("turn")).first()[0]
    # stored as words: else every pair of every template would take the paragraph apart again
    others = stored(drawn.filter(draw <= F.lit(last)).select(F.slice(words(F.col("paragraph")), 1, LONGEST).alias("words")).distinct())
    pairs = stored(others.select("words", _pairs(F.col("words")).alias("pairs")))
    others = stored(pairs.filter(F.coalesce(F.array_max(_shares(F.col("pairs"))), F.lit(0.0)) < ALIKE / 2).select("words"))
    rows = stored(_terms(_variants(spark, others).withColumn("label", F.col("label").cast("double"))).select("label", "features", "words"))
    learn = hash_share("words", seed=59) < 0.8
    # every family weighs the same, whatever its number of templates, and all of them together as much as the rest
    of_label = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = F.create_map(*[F.lit(x) for k, n in of_label.items() for x in (k, 100.0 * (len(FAMILIES) - 1 if k == 0 else 1) / n)])
    train = rows.filter(learn | (F.col("label") > 0)).select("label", "features", weight[F.col("label")].alias("weight")).coalesce(FIT_PARTS)
    model = LogisticRegression(family="multinomial", maxIter=40, regParam=2e-4, weightCol="weight").fit(train)
    sure = vector_to_array("probability")[F.col("prediction").cast("int")]
    steps = model.transform(rows.filter(~learn)).groupBy("prediction", F.floor(sure * 50).cast("int").alias("step"))
    counts = steps.agg(F.sum((F.col("label") == F.col("prediction")).cast("int")).alias("right"), F.count(F.lit(1)).alias("n")).collect()
    limits = []
    for k in range(model.numClasses):
        right = seen = 0
        limit = 0.9
        for step in range(50, 14, -1):
            for r in counts:
                if r["prediction"] == k and r["step"] == step:
                    right, seen = right + r["right"], seen + r["n"]
            if seen and right >= precision * seen:
                limit = step / 50
        limits.append(limit)
    return model, limits


def _wanted() -> Column:
    """The word pairs of each template, in the order of TEMPLATES: one constant, so that plans do not grow with the templates."""
    return F.array(*[F.array(*[F.lit(p) for p in dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:]))]) for w in (_plain_words(t) for _, t in TEMPLATES)])


def _shares(own: Column) -> Column:
    """Share of each template's word pairs that stand among the given pairs, in the order of TEMPLATES."""
    return F.transform(_wanted(), lambda pairs: F.size(F.array_intersect(own, pairs)) / F.size(pairs))


def _plain_words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+(?:[-.][^\W_]+)*", text.lower())


def _stand(own: Column, k: Column) -> Column:
    """The first and the last word that the pairs of template ``k`` need, each pair where it stands last; ``own`` are all pairs from the last to the first."""
    places = F.transform(F.array_intersect(own, F.get(_wanted(), k)), lambda p: (F.size(own) - F.array_position(own, p)).cast("int"))
    return F.struct(F.array_min(places).alias("first"), (F.array_max(places) + 1).alias("last"))


def hits(docs: DataFrame, at_most: int = AT_MOST) -> DataFrame:
    """(rid, doc_id, alone, line, last, family, chance, likeness) of confirmed lines and windows; a paragraph without one has a row of nulls."""
    model, limits = fit(lines_of(docs), at_most)
    scored = model.transform(_terms(units(docs).withColumn("words", F.coalesce("words", F.array().cast("array<string>")))))
    best = F.col("prediction").cast("int")
    scored = scored.select("rid", "doc_id", "alone", "words", "at", "wide", best.alias("k"), vector_to_array("probability")[best].alias("chance"))
    limit = F.array(*[F.lit(x) for x in limits])[F.col("k")]
    passed = F.col("alone").isNotNull() & (F.col("k") > 0) & (F.col("chance") >= limit)
    named = F.array(*[F.lit(FAMILIES.index(f)) for f, _ in TEMPLATES])
    own = lambda c: F.zip_with(c, named, lambda x, f: F.when(f == F.col("k"), x).otherwise(-1.0))
    # what passed is few rows: each step is stored, so that no comparison with the templates is made twice
    kept = stored(scored.select("rid", "doc_id", F.when(passed, F.struct("alone", "words", "at", "wide", "k", "chance")).alias("u")))
    alike = [_shares(F.col(c)).alias(n) for c, n in (("own", "here"), ("beside", "around"))]
    scored = stored(kept.filter("u is not null").select("rid", "doc_id", "u.*").withColumns({"own": _pairs(F.col("words")), "beside": _pairs(F.col("wide"))}))
    scored = stored(scored.select("rid", "doc_id", "alone", "words", "at", "k", "chance", *alike)).withColumn("likeness", F.array_max(own(F.col("here"))))
    scored = scored.withColumns({"which": F.array_position(own(F.col("here")), F.col("likeness")) - 1, "most": F.array_max(own(F.col("around")))})
    other = F.exists(F.arrays_zip("here", "around", named.alias("f")), lambda t: (t["f"] != F.col("k")) & (t["here"] >= F.col("likeness")) & (t["around"] > F.col("most")))
    scored = scored.withColumn("fine", F.coalesce((F.col("likeness") >= ALIKE) & ~other, F.lit(False))).withColumn("backwards", F.reverse(_pairs(F.col("words"))))
    fine = F.col("fine")
    family = F.array(*[F.lit(f) for f in FAMILIES])[F.col("k")]
    scored = stored(scored.withColumn("where", F.when(fine, _stand(F.col("backwards"), F.col("which").cast("int")))).drop("backwards"))
    found = scored.select("rid", "doc_id", *[F.when(fine, c).alias(n) for n, c in (
        ("alone", F.col("alone")), ("line", F.col("at")[F.col("where.first")]), ("last", F.col("at")[F.col("where.last")]), ("family", family),
        ("chance", F.col("chance")), ("likeness", F.col("likeness")))])
    others = kept.filter("u is null").select("rid", "doc_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields[2:]])
    return found.unionByName(others)


def _number(of: Column) -> Column:
    """How many hits the sorted (family, line, last, alone) are."""
    start = F.struct(F.lit("").alias("family"), F.lit(-1).alias("last"), F.lit(-1).alias("alone"), F.lit(0).alias("n"))

    def put(done: Column, h: Column) -> Column:
        same = (done["family"] == h["family"]) & (h["line"] <= done["last"])
        before = F.when(same, done["alone"]).otherwise(F.lit(-1))
        more = F.when(~same | (h["alone"] & (before >= 0) & (before != h["line"])), 1).otherwise(0)
        return F.struct(
            h["family"].alias("family"), F.when(same, F.greatest(done["last"], h["last"])).otherwise(h["last"]).alias("last"),
            F.when(h["alone"], h["line"]).otherwise(before).alias("alone"), (done["n"] + more).alias("n"))

    return F.aggregate(of, start, put, lambda done: done["n"].cast("bigint"))


def scan(docs: DataFrame, at_most: int = AT_MOST) -> DataFrame:
    """Per text: doc_id, n_hits, families (sorted, comma-joined), first_line, chance (largest)."""
    hit = F.when(F.col("family").isNotNull(), F.struct("family", "line", "last", "alone"))
    rows = hits(docs, at_most).groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set(hit)).alias("all"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
        F.min("line").alias("first_line"), F.max("chance").alias("chance"))
    return rows.select("doc_id", _number(F.col("all")).alias("n_hits"), "families", "first_line", "chance")
