"""Licence notices of the corpus, altered notices, and the cue shortcut."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from shelfwise.llm import license_scan as ls

PLANTED = {"This work is licensed under the GNU General Public License, version 3.": "gpl", "Released under the MIT License.": "mit",
           "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under the Apache License, Version 2.0.": "apache",
           "All rights reserved.": "proprietary"}


@pytest.fixture(scope="module")
def model(spark):
    return ls.fit_license_model(spark.read.parquet(f"{SF01}/documents.parquet"))


def test_query_finds_every_notice_and_no_other(spark):
    rows = ls.op1_license_scan(spark, SF01).collect()
    found = {(r.doc_id, r.paragraph): r.family for r in rows if r.family != ls.UNKNOWN}
    want = {(r.doc_id, k): PLANTED[line] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()
            for k, line in enumerate(r.text.split("\n")) if line in PLANTED}
    assert want and found == want
    assert all(r.confirmed == (r.family != ls.UNKNOWN) for r in rows)


def test_altered_notices_and_cases(spark, model):
    texts = [(1, "intro\nreleased UNDER the mit license\n\nend"), (2, "Licensed under the GNU General Public License version 2 or later"),
             (3, "This is a license plate and a public school"), (4, None), (5, ""), (6, " \n\t"), (7, "Released under the MIT License."),
             (7, "Released under the MIT License."), (8, "licence " * 20_000 + "\nAll rights reserved.")]
    df = spark.createDataFrame([(*t, "x", 0.5, "f") for t in texts], "doc_id long, text string, source string, _share double, family string")
    rows = ls.scan_licenses(df, model).collect()
    got = {(r.doc_id, r.paragraph): r.family for r in rows if r.confirmed}
    assert got[1, 1] == "mit" and got[2, 0] == "gpl" and got[8, 1] == "proprietary"
    assert not any(d in (3, 4, 5, 6) for d, _ in got)
    assert sum(r.doc_id == 7 for r in rows) == 2 and rows[0].source == "x"
    assert ls.scan_licenses(df.limit(0), model).count() == 0


def test_paragraphs_without_a_cue_are_unknown(spark, model):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    lines = ls.paragraphs(docs, F.col("text")).filter(~F.arrays_overlap("_words", F.array(*map(F.lit, model.cues))))
    scored = model.regression.transform(model.vector.transform(lines.withColumn("_grams", ls._grams(F.col("_words")))))
    best = F.array_max(F.slice(ls._probabilities(scored, model.temperature), 1, len(model.families) - 1))
    assert scored.agg(F.max(best)).first()[0] < model.threshold


def test_weights_are_sparse(model):
    weights = abs(model.regression.coefficientMatrix.toArray())
    assert 0 < (weights > 0).mean() < 0.5


def test_empty_corpus(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ls.scan_licenses(empty, ls.fit_license_model(empty)).count() == 0


WRAPPED = {
    "bsd": "/* Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions are met: */",
    "gpl": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License",
    "mpl": "// This Source Code Form is subject to the terms of the Mozilla\n// Public License, v. 2.0.",
    "apache": " * Licensed under the Apache License, Version\n * 2.0 (the \"License\"); you may not use this file except\n * in compliance with the License.",
}
UNLISTED = ["Distributed under the Boost Software License, Version 1.0.",
            "Boost Software License - Version 1.0",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"]


def test_wrapped_notices_are_one_paragraph(spark, model):
    rows = [(k, f"some prose before it\n\n{text}\n\nand some after it", family) for k, (family, text) in enumerate(WRAPPED.items())]
    rows += [(100 + k, f"x\n{t}\ny", ls.UNKNOWN) for k, t in enumerate(UNLISTED)]
    found = ls.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, want string"), model).collect()
    for k, text, want in rows:
        mine = [r for r in found if r.doc_id == k]
        if want == ls.UNKNOWN:
            assert {r.family for r in mine} <= {ls.UNKNOWN}, mine
        else:
            assert [r.family for r in mine if r.confirmed] == [want], mine
            lines = text.split("\n")
            best = next(r for r in mine if r.confirmed)
            assert 2 <= best.paragraph <= best.last_line <= len(lines) - 3
