"""License scan: a trained paragraph classifier, confirmed against templates.

A notice stands in one line or is wrapped over several, often behind comment marks.
So a paragraph is a line, or a run of neighbouring lines that each hold a *cue* word
(below); words are runs of letters and digits, so comment marks are none, and a line
without a word ends a run.  A run is reported in place of its lines where it is confirmed
as a whole and none of its lines is by itself.

Paragraphs are described by their word unigrams and bigrams.  A multinomial logistic
regression with an L1 penalty, so that few n-grams carry weight, assigns a licence family or
``unknown``.  It is trained here: positives are the notices of ``TEMPLATES``, each alone and
run together with text of the corpus; ``unknown`` are corpus paragraphs that share no
word triple with a template (at most ``MAX_NEGATIVES``, those of smallest hash) and, in
the same two forms, the notices of ``OTHERS``, licences of no listed family.  N-grams common
among the corpus paragraphs, or made of such words alone, are no features.

Calibration: the notices and corpus paragraphs are dealt into ``FOLDS``.  For each fold a model
is fitted without its notices, its paragraphs *and* every notice of a third of the families,
and predicts them; for it those families are unknown.  On these predictions a temperature
is chosen that minimises the log loss, then the least probability at which no more than
``FALSE_RATE`` of the corpus paragraphs and ``UNSEEN_RATE`` of the notices of unseen families pass
for a licence; paragraphs below it are ``unknown``.

Confirmation: the share of the predicted family's best template whose word triples
the paragraph holds must reach ``MIN_SIMILARITY``.

A paragraph without any of the weighted n-grams scores as the bias alone, which is
``unknown``; so only paragraphs that hold a *cue* word (each feature has one) are
scored, which changes no result.

Defined cases: NULL, empty and blank texts have no paragraphs; texts of any length are
read whole; of equally probable families the first in the alphabet is taken; repeated rows are
reported as often as they occur; in an empty table nothing is found; other columns
pass through, except those named like a result column or with a leading ``_``, which
are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import lowest_keys, read_table, written

UNKNOWN = "unknown"
#: Short public notices of each family.
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Licensed under CC BY-NC-SA 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
            "Dedicated to the public domain under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
            "Released under the GNU Lesser General Public License.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            "SPDX-License-Identifier: MIT"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "No part of this publication may be reproduced without prior written permission."],
}
#: Short public notices of licences of no family above.
OTHERS = ["This software is provided 'as-is', without any express or implied warranty.", "Released under the zlib License.",
          "This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Zlib",
          "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
          "Licensed under the Academic Free License version 3.0", "Licensed under the Open Software License version 3.0",
          "Distributed under the terms of the Artistic License 2.0.", "Licensed under the PostgreSQL License, Version 1.0.",
          "Distributed under the Python Software Foundation License, Version 2.", "SPDX-License-Identifier: EPL-2.0",
          "Licensed under the European Union Public Licence, Version 1.2", "Released under the Do What The Fuck You Want To Public License.",
          "Permission to copy and distribute verbatim copies of this document is granted to any person.",
          "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it",
          "The author disclaims all warranties with regard to this work, including implied warranties of merchantability."]
MAX_NEGATIVES = 3_000
COPIES = 30  # corpus paragraphs that each template is run together with
COMMON_SHARE = 0.01
VOCABULARY = 4_096
PENALTY = 0.0005
FOLDS = 3
FALSE_RATE, UNSEEN_RATE = 0.002, 0.25
MIN_SIMILARITY = 0.5
MOST_CERTAIN = 0.9  # no threshold is above this
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
CONTEXT_WORDS = 12
FIT_PARTITIONS = 8  # of the bounded sample that every iteration of the fit reads
RESULT = ("paragraph", "last_line", "family", "probability", "similarity", "confirmed")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _grams(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))),
                       lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.array_distinct(F.concat(words, F.filter(pairs, lambda p: p.isNotNull())))


def _triples(words: Column) -> Column:
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.array_join(F.slice(words, i, 3), " "))
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(runs))


def templates(spark: SparkSession) -> DataFrame:
    """``family, notice, triples`` of the fixed notices."""
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("notice")) for f, ts in TEMPLATES.items() for t in ts])
    return spark.range(1).select(F.explode(rows).alias("t")).select("t.family", "t.notice", _triples(_words(F.col("t.notice"))).alias("triples"))


def paragraphs(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``paragraph`` (its number in the text) and ``_words``, for each line that holds a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return docs.select("*", F.posexplode(lines).alias("paragraph", "_line")).withColumn("_words", _words(F.col("_line"))) \
        .filter(F.size("_words") > 0).drop("_line")


def _units(docs: DataFrame, text: Column, cues: Column, text_col: str) -> DataFrame:
    """``_doc, _row, _run, paragraph, last_line, _words``: each line that holds a cue word, and
    each run of two or more neighbouring ones."""
    doc = F.struct(*[c for c in docs.columns if c != text_col], F.lit(None).cast("string").alias("_none"))
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x, i: F.struct(i.alias("at"), _words(x).alias("words")))
    marked = F.filter(lines, lambda x: F.arrays_overlap(x["words"], cues))
    placed = F.transform(marked, lambda x, k: F.struct((x["at"] - k).alias("run"), x["at"].alias("at"), x["words"].alias("words")))
    rows = docs.select(doc.alias("_doc"), F.monotonically_increasing_id().alias("_row"), placed.alias("_lines"))
    single = rows.select("_doc", "_row", F.explode("_lines").alias("x")).select(
        "_doc", "_row", F.col("x.run").alias("_run"), F.col("x.at").alias("paragraph"), F.col("x.at").alias("last_line"), F.col("x.words").alias("_words"))
    single = written(single, "license-lines")
    runs = single.groupBy("_row", "_run").agg(F.first("_doc").alias("_doc"), F.sort_array(F.collect_list(F.struct("paragraph", "_words"))).alias("x")) \
        .filter(F.size("x") > 1).select("_doc", "_row", "_run", F.get("x.paragraph", F.lit(0)).alias("paragraph"),
                                        F.element_at("x.paragraph", -1).alias("last_line"), F.flatten("x._words").alias("_words"))
    return single.unionByName(runs)


def _negatives(docs: DataFrame, text_col: str, triples: list[str], limit: int) -> DataFrame:
    """Corpus paragraphs unlike any template, of smallest hash: one drawn per
    document, then the first ``limit``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(text)

    def line_of(text, key):
        lines = F.split(text, "\n")
        return F.get(lines, F.pmod(key, F.size(lines).cast("long")).cast("int"))

    drawn = lowest_keys(docs.select(key.alias("_key"), text.alias("_text")), "_key", limit).select("_key", _words(line_of(F.col("_text"), F.col("_key"))).alias("words"))
    known = F.array(*map(F.lit, triples))
    return drawn.filter((F.size("words") > 0) & ~F.arrays_overlap(_triples(F.col("words")), known)).select("_key", "words")


class LicenseModel:
    """Fitted stages, the cue words, and the calibration."""

    def __init__(self, families, vector, regression, cues, temperature, threshold):
        self.families, self.vector, self.regression = families, vector, regression
        self.cues, self.temperature, self.threshold = cues, temperature, threshold


def _padded(raw: Column, size: int) -> Column:
    """Raw scores of a model whose last labels were not in its fit, in full length."""
    from pyspark.ml.functions import vector_to_array

    seen = vector_to_array(raw)
    return F.concat(seen, F.array_repeat(F.lit(-50.0), F.greatest(F.lit(0), F.lit(size) - F.size(seen))))


def _probabilities(scored: DataFrame, temperature: float) -> Column:
    from pyspark.ml.functions import vector_to_array

    raw = F.col("_raw") if dict(scored.dtypes)["_raw"].startswith("array") else vector_to_array(F.col("_raw"))
    powers = F.transform(raw, lambda x: F.exp((x - F.array_max(raw)) / temperature))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def fit_license_model(docs: DataFrame, text_col: str = "text", max_negatives: int = MAX_NEGATIVES) -> LicenseModel:
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    spark = docs.sparkSession
    families = [*sorted(TEMPLATES), UNKNOWN]
    known = templates(spark)
    triples = sorted({t for r in known.select("triples").collect() for t in r.triples})  # of the fixed notices
    negatives = written(_negatives(docs, text_col, triples, max_negatives).coalesce(FIT_PARTITIONS), "license-negatives")
    total = negatives.count()
    common = negatives.select(F.explode(_grams(F.col("words"))).alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    common = {r.g: r.n for r in common.filter(F.col("n") > COMMON_SHARE * total).collect()}  # at most words per row / COMMON_SHARE

    notice = _words(F.col("notice"))
    others = spark.range(1).select(F.explode(F.array(*map(F.lit, OTHERS))).alias("notice")).select(F.lit(UNKNOWN).alias("family"), "notice")
    notices = known.select("family", "notice").unionByName(others).withColumn("part", F.pmod(F.xxhash64("notice"), F.lit(FOLDS)).cast("int"))
    alone = notices.select("family", notice.alias("words"), F.xxhash64("notice").alias("_key"), "part", F.lit(True).alias("noticed"))
    count = sum(map(len, TEMPLATES.values())) + len(OTHERS)
    numbered = notices.select("family", notice.alias("notice"), "part", (F.row_number().over(_fixed_order()) - 1).alias("slot"))
    context = negatives.withColumn("slot", F.pmod("_key", F.lit(count * 4))).filter(F.col("slot") < count) if total > 4 * count * COPIES \
        else negatives.withColumn("slot", F.pmod("_key", F.lit(count)))
    mixed = context.join(numbered, "slot").select(
        "family", F.when(F.pmod(F.shiftright("_key", 8), F.lit(2)) == 0, F.concat("notice", F.slice("words", 1, CONTEXT_WORDS)))
        .otherwise(F.concat(F.slice("words", 1, CONTEXT_WORDS), "notice")).alias("words"), "_key", "part", F.lit(True).alias("noticed"))
    plain = negatives.select(F.lit(UNKNOWN).alias("family"), "words", "_key",
                             F.pmod(F.shiftright("_key", 20), F.lit(FOLDS)).cast("int").alias("part"), F.lit(False).alias("noticed"))
    rows = alone.unionByName(mixed).unionByName(plain)
    skipped = F.array(*map(F.lit, sorted(common))) if common else F.array().cast("array<string>")
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1

    def telling(gram):  # not common, and with a word that isn't
        return ~F.array_contains(skipped, gram) & F.exists(F.split(gram, " "), lambda w: ~F.array_contains(skipped, w))

    rows = rows.select(F.filter(_grams(F.col("words")), telling).alias("_grams"), label.alias("_y"), "part", "noticed", "family")
    rows = written(rows.coalesce(FIT_PARTITIONS), "license-rows")
    vector = CountVectorizer(inputCol="_grams", outputCol="_x", vocabSize=VOCABULARY, minDF=2.0, binary=True).fit(rows.filter("noticed"))
    rows = written(vector.transform(rows).drop("_grams"), "license-vectors")
    learner = LogisticRegression(featuresCol="_x", labelCol="_y", predictionCol="_guess", rawPredictionCol="_raw",
                                 probabilityCol="_p", family="multinomial", elasticNetParam=1.0, regParam=PENALTY, maxIter=60)
    regression = learner.fit(rows)

    weights = abs(regression.coefficientMatrix.toArray()).max(0)
    used = [g for g, w in zip(vector.vocabulary, weights) if w > 0]
    seen = {w: common.get(w, 0) for g in used for w in g.split(" ")}
    cues = sorted({min(g.split(" "), key=lambda w: (seen[w], w)) for g in used})

    # predictions of models that have not seen the notice, the paragraph or the family
    unknown = float(len(families) - 1)
    back = None
    for k in range(FOLDS):
        unseen = F.col("family").isin(*sorted(TEMPLATES)[k::FOLDS])
        held = (F.col("part") == k) | unseen
        one = learner.fit(rows.filter(~held).unionByName(rows.filter(F.col("_y") == unknown).limit(1))).transform(rows.filter(held)) \
            .select(_padded(F.col("_raw"), len(families)).alias("_raw"), F.when(unseen, unknown).otherwise(F.col("_y")).alias("_y"), (unseen | (F.col("noticed") & (F.col("_y") == unknown))).alias("strange"))
        back = one if back is None else back.unionByName(one)
    back = written(back, "license-held-out")
    losses = [F.avg(-F.log(F.get(_probabilities(back, t), F.col("_y").cast("int")) + 1e-12)).alias(f"t{k}") for k, t in enumerate(TEMPERATURES)]
    found = back.agg(*losses).first()
    temperature = min(zip((x if x is not None else 0.0 for x in found), TEMPERATURES))[1]
    best = F.array_max(F.slice(_probabilities(back, temperature), 1, len(families) - 1))
    edges = [back.filter((F.col("_y") == unknown) & (F.col("strange") == strange)).agg(F.percentile_approx(best, 1 - rate, 10_000)).first()[0]
             for strange, rate in ((False, FALSE_RATE), (True, UNSEEN_RATE))]
    edge = max((e for e in edges if e is not None), default=0.5)
    return LicenseModel(families, vector, regression, cues, temperature, min(max(0.5, edge), MOST_CERTAIN))


def _fixed_order():
    return Window.orderBy("family", "notice")  # over the fixed notices


def scan_licenses(docs: DataFrame, model: LicenseModel, text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` other than the text with ``paragraph`` (its first line),
    ``last_line, family, probability, similarity, confirmed``, for each paragraph that holds a cue word."""
    spark = docs.sparkSession
    docs = docs.select(*[c for c in docs.columns if c == text_col or not (c.startswith("_") or c in RESULT)])
    text = F.col(text_col).cast("string")
    cues = F.array(*map(F.lit, model.cues)) if model.cues else F.array().cast("array<string>")
    plausible = docs.filter(F.arrays_overlap(_words(F.coalesce(text, F.lit(""))), cues))
    lines = _units(plausible, text, cues, text_col)
    scored = model.regression.transform(model.vector.transform(lines.withColumn("_grams", _grams(F.col("_words")))))
    share = _probabilities(scored, model.temperature)
    known = F.slice("_share", 1, len(model.families) - 1)
    sure = scored.withColumn("_share", share).withColumn("probability", F.array_max(known)).withColumn(
        "family", F.when(F.col("probability") >= model.threshold,
                         F.get(F.array(*map(F.lit, model.families)), F.array_position(known, F.array_max(known)).cast("int") - 1))
        .otherwise(UNKNOWN))
    notices = {f: [r.triples for r in templates(spark).filter(F.col("family") == f).collect()] for f in TEMPLATES}

    def likeness(rows):
        have = F.col("_triples")
        return F.greatest(F.lit(0.0), *[F.size(F.array_intersect(have, F.array(*map(F.lit, t)))) / len(t) for t in rows])

    similarity = F.lit(0.0)
    for family, rows in notices.items():
        similarity = F.when(F.col("family") == family, likeness(rows)).otherwise(similarity)
    out = sure.withColumn("_triples", _triples(F.col("_words"))).withColumn("similarity", similarity)
    kept = [F.col(f"_doc.{c}").alias(c) for c in docs.columns if c != text_col]
    out = out.withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("similarity") >= MIN_SIMILARITY))
    alone = F.col("paragraph") == F.col("last_line")
    run = Window.partitionBy("_row", "_run")
    out = out.withColumns({"_by_line": F.max(F.col("confirmed") & alone).over(run), "_by_run": F.max(F.col("confirmed") & ~alone).over(run)})
    whole = ~F.col("_by_line") & F.col("_by_run")  # only the run as a whole is confirmed
    return out.filter(F.when(whole, ~alone).otherwise(alone)).select(*kept, "paragraph", "last_line", "family", "probability", "similarity", "confirmed")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, fit_license_model(docs))
