"""Licence notices are found and named; other text is left alone."""

import random
import re

from pyspark.sql import functions as F

from loanframe.llm import licences
from loanframe.llm.common import table
from loanframe.llm.queries import op8_license
from tests.llm.fixtures import clashing, docs, same_rows

NAMED = {"GPL-3.0": "gnu general public license, version 3", "CC-BY-NC": "cc by-nc 4.0", "MIT": "the mit license", "Apache-2.0": "apache license, version 2.0"}
FOLDER = "/root/testdata/sf0.01"


def test_query_finds_every_notice_and_nothing_else(spark):
    texts = {r.doc_id: (r.text or "").lower() for r in table(spark, FOLDER, "documents").collect()}
    found = {r.doc_id: r for r in op8_license(spark, FOLDER).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        assert found[i].families == ",".join(sorted(k for k, p in NAMED.items() if p in text)), (i, found[i])
        assert (found[i].n_hits > 0) == (found[i].first_line is not None) == (found[i].chance is not None)


def test_templates_names_and_awkward_rows(spark):
    known = list(dict(reversed([(f, t) for f, t in licences.TEMPLATES])).items())
    rows = [(10_000 + k, f"Some prose first.\r\n  {t.upper()}  \nand more", None, None, None) for k, (_, t) in enumerate(known)]
    given = docs(spark).unionByName(spark.createDataFrame(rows, docs(spark).schema))
    other = table(spark, FOLDER, "documents").select(docs(spark).columns)
    found = {r.doc_id: r for r in licences.scan(given.unionByName(other)).collect() if r.doc_id is None or r.doc_id >= 10_000 or r.doc_id in (3, 4, 6)}
    for k, (family, _) in enumerate(known):
        assert found[10_000 + k].families == family and found[10_000 + k].first_line == 1
    assert all(found[i].families == "" and found[i].n_hits == 0 for i in (3, 4, 6))
    assert same_rows(licences.scan(given), licences.scan(clashing(given)))
    assert licences.scan(given.limit(0)).count() == 0


WRAPPED = {
    "GPL-3.0": """/*
 * frob - frobnicates files
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */""",
    "BSD": """# Copyright (c) 2019, The Authors
# All rights reserved.
#
# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
# 1. Redistributions of source code must retain the above copyright notice""",
    "MIT": """// Copyright (c) 2020 The Authors
//
// Permission is hereby granted, free of charge, to any person obtaining
// a copy of this software and associated documentation files (the
// "Software"), to deal in the Software without restriction""",
}


def test_notices_wrapped_over_lines(spark):
    other = table(spark, FOLDER, "documents").select(docs(spark).columns)
    prose = " ".join(r.text for r in other.filter("text is not null").orderBy("doc_id").limit(3).collect())
    rows, want = [], {}
    for k, (family, text) in enumerate(WRAPPED.items()):
        bare = [re.sub(r"^\W+", "", line) for line in text.splitlines()]
        line = min(i for i, x in enumerate(bare) if re.match("it under|Redistribution and|Permission", x))
        for n, (form, first) in enumerate([(text, line), ("\r\n".join(bare), line), (" ".join(prose.split()[:500] + bare + prose.split()[500:900]), 0)]):
            rows.append((20_000 + 10 * k + n, form, None, None, None))
            want[rows[-1][0]] = (family, 1, first)
    # halves of a notice parted by a blank line are no notice
    rows.append((20_100, "with or without modification, are permitted\n\nRedistribution and use in source", None, None, None))
    want[20_100] = ("", 0, None)
    found = licences.scan(other.unionByName(spark.createDataFrame(rows, other.schema))).filter("doc_id >= 20000").collect()
    assert {r.doc_id: (r.families, r.n_hits, r.first_line) for r in found} == want


FORMS = {
    "SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "// spdx-license-identifier: GPL-2.0-or-later": "GPL-2.0",
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice appear in all copies.": "ISC",
    " * Distributed under the Boost Software License, Version 1.0.\n * (See accompanying file LICENSE_1_0.txt)": "BSL-1.0",
    "This program and the accompanying materials\nare made available under the terms of the Eclipse Public License 2.0\nwhich accompanies this distribution": "EPL-2.0",
    "  Permission is granted to anyone to use this software for any purpose,\n  including commercial applications, and to alter it and redistribute it\n  freely, subject to the following restrictions:": "Zlib",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.': "MIT",
    "Licensed under GPLv3": "GPL-3.0", "MIT licensed": "MIT", "frob 2.1 - MIT licensed, see COPYING": "MIT",
    "This project, frob, is released under the MIT License (see the file COPYING)": "MIT",
    "This library is licensed under the terms of the GNU Lesser General Public License, see below": "LGPL",
}
CLEAN = ["The permission of the software authority was granted to any person of age.", "A licensed driver under the age of thirty.", "version 2.0 of the public terms of use",
         "He provided the warranty as is, without any software.", "The mit of the glove was free of charge.", "This identifier is Apache, the tribe."]


def test_other_forms_of_notices(spark):
    other = table(spark, FOLDER, "documents").select(docs(spark).columns)
    rows = [(30_000 + k, f"Some words of prose first.\n\n{form}\n\nAnd prose after it.", None, None, None) for k, form in enumerate([*FORMS, *CLEAN])]
    found = licences.scan(other.unionByName(spark.createDataFrame(rows, other.schema))).filter("doc_id >= 30000").collect()
    want = {30_000 + k: family for k, family in enumerate([*FORMS.values(), *[""] * len(CLEAN)])}
    assert {r.doc_id: r.families for r in found} == want


def test_main_path_has_no_python(spark):
    plan = op8_license(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_fit_shuffles_no_gradients(spark, monkeypatch):
    """However many partitions the examples have, the classifier's steps add up without a shuffle."""
    seen = []
    whole = licences.LogisticRegression.fit

    def fit(self, rows):
        seen.append(rows.rdd.getNumPartitions())
        return whole(self, rows)

    monkeypatch.setattr(licences.LogisticRegression, "fit", fit)
    lines = licences.lines_of(table(spark, "/root/testdata/sf0.001", "documents").select("text").repartition(64))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        licences.fit(lines, 200)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert seen and max(seen) <= licences.FIT_PARTS


def test_driver_holds_no_plan_per_template_and_one_gradient(spark, monkeypatch):
    """The driver plans the comparison once, not for every template, and a step of the fit sends it the gradients of one partition."""
    plans, parts = [], []
    whole, fit = licences.stored, licences.LogisticRegression.fit

    def stored(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return whole(rows)

    def fitted(self, rows):
        parts.append(rows.rdd.getNumPartitions())
        return fit(self, rows)

    monkeypatch.setattr(licences, "stored", stored)
    monkeypatch.setattr(licences.LogisticRegression, "fit", fitted)
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        op8_license(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    compared = [p.count("array_intersect(") for p in plans]
    assert any(compared) and max(compared) <= 2 and parts == [1]


def test_shares_and_places_as_in_plain_python(spark):
    draw = random.Random(8)
    templates = [licences._plain_words(t) for _, t in licences.TEMPLATES]
    rows = [(k, [w for w in draw.choices(["of", "the"], k=draw.randrange(4)) + t * draw.randrange(1, 3) if draw.random() < 0.8]) for k, t in enumerate(templates)]
    rows += [(0, []), (1, ["license"]), (2, ["the", "the", "the"])]
    pairs = licences._pairs(F.col("words"))
    given = spark.createDataFrame(rows, "k int, words array<string>").withColumns({"own": pairs, "backwards": F.reverse(pairs)})
    for r in given.select("k", "words", licences._shares(F.col("own")).alias("shares"), licences._stand(F.col("backwards"), F.col("k")).alias("at")).collect():
        own = list(zip(r.words, r.words[1:]))
        wanted = [set(zip(t, t[1:])) for t in templates]
        assert r.shares == [len(w & set(own)) / len(w) for w in wanted]
        last = [len(own) - 1 - own[::-1].index(p) for p in wanted[r.k] & set(own)]
        assert (r["at"].first, r["at"].last) == ((min(last), max(last) + 1) if last else (None, None))
