"""Held-out accuracy and lookup-table behaviour of the quality model."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from shelfwise.llm import quality_gam as qg


def test_query_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in qg.op9_quality_gam(spark, SF01).collect()}
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(rows[d].predicted, y) for d, y in labels.items() if rows[d].held_out]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) >= 0.97


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(qg.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = qg.fit_quality_model(docs, labels), qg.fit_quality_model(docs, flipped)
    assert a.base == b.base and all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = qg.fit_gam(x, y)
    assert {tuple(sorted(p[:2])) for p in model.pairs} >= {(0, 1)}
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "x y. " * 30_000, "b"), (2, "", "c")],
                                 "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = qg.fit_quality_model(docs, none)
    out = qg.score_quality(docs, model, score_col="q")
    assert out.columns == ["doc_id", "text", "score", "q"]
    assert [round(r.q, 6) for r in out.collect()] == [0.5] * 4
    seen = [i for i in range(50) if zlib.crc32(str(i).encode()) % 3 != 1][:3]
    one = spark.createDataFrame([(seen[0], 1, 0), (seen[0], 1, 0), (seen[1], 1, 0), (seen[2], None, 0)], none.schema)
    model = qg.fit_quality_model(spark.createDataFrame([(i, "w", "") for i in seen], docs.schema), one)
    assert all(r.q > 0.9 for r in qg.score_quality(docs, model, score_col="q").collect())
    assert qg.keep_quality(docs.limit(0), one).count() == 0
    assert qg.features_of(" \n ").tolist() == [0.0] * len(qg.FEATURES)
