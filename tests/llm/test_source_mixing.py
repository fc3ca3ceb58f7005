"""Raking against a numpy loop, calibration and the draw."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from shelfwise.llm import source_mixing as sm


def test_raked_weights_equal_numpy(spark):
    rng = np.random.default_rng(4)
    cells = [(s, g, t, int(rng.integers(1, 500))) for s, g, t in itertools.product(["a", "b", "c"], ["x", "y"], [0, 1, 2])
             if (s, g, t) != ("c", "y", 2)]
    df = spark.createDataFrame(cells, "_source string, _lang string, _topic int, tokens long")
    want = {"source": {"a": 0.2, "b": 0.5, "c": 0.3}, "lang": {"x": 0.6, "y": 0.4}, "topic": {0: 0.1, 1: 0.3, 2: 0.6}}
    kinds = {"source": "string", "lang": "string", "topic": "int"}
    targets = {d: spark.createDataFrame(list(v.items()), f"_{d} {kinds[d]}, target double") for d, v in want.items()}
    got = {(r._source, r._lang, r._topic): r.weight for r in sm.rake(df, targets, tolerance=1e-6).collect()}
    w = {c[:3]: c[3] / sum(x[3] for x in cells) for c in cells}
    for _ in range(200):
        for i, d in enumerate(sm.DIMENSIONS):
            for v, share in want[d].items():
                keys = [k for k in w if k[i] == v]
                total = sum(w[k] for k in keys)
                for k in keys:
                    w[k] *= share / total
    assert got.keys() == w.keys()
    assert all(got[k] == pytest.approx(w[k], abs=1e-4) for k in w)
    for i, d in enumerate(sm.DIMENSIONS):
        for v, share in want[d].items():
            assert sum(x for k, x in got.items() if k[i] == v) == pytest.approx(share, abs=1e-4)


def test_query_meets_the_budget(spark):
    rows = sm.op4_source_mixing(spark, SF01).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(r.n_tokens == len(docs[r.doc_id].text.split()) for r in rows)
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(sm.BUDGET * total, rel=2e-3)
    assert sum(r.n_tokens for r in rows if r.sampled) == pytest.approx(sm.BUDGET * total, rel=0.1)
    assert all(0 <= r.probability <= 1 for r in rows)


def test_explicit_targets_and_cases(spark):
    docs = [(i, "word " * (20 + i % 7), "s" if i % 2 else None, "en", "x") for i in range(400)]
    docs += [(900, None, "s", None, "x"), (901, "", "s", "en", "x"), (5, docs[5][1], "s", "en", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, topic string")
    share = spark.createDataFrame([(None, 0.9), ("s", 0.1), ("absent", 3.0)], "source string, share double")
    out = sm.mixed(df, targets={"source": share}, budget=0.3).collect()
    assert len(out) == len(docs)
    mass = lambda rows: sum(r._tokens * r._probability for r in rows)
    assert mass(out) == pytest.approx(0.3 * sum(r._tokens for r in out), rel=1e-3)
    assert mass([r for r in out if r.source is None]) == pytest.approx(0.9 * mass(out), rel=1e-3)
    assert len({r._sampled for r in out if r.doc_id == 5}) == 1
    assert {r.doc_id: r._probability for r in out}[900] == 0.3
    kept = sm.sample_mix(df, targets={"source": share}, budget=0.3)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out if r._sampled)
    assert sm.sample_mix(df.limit(0)).count() == 0
    blank = df.filter("doc_id >= 900")
    assert sm.mixed(blank).filter(F.col("_probability") == sm.BUDGET).count() == 2


def test_marginals_of_the_probabilities_are_the_targets(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    report = sm.mix_report(docs).collect()
    assert {r.dimension for r in report} == set(sm.DIMENSIONS)
    for d in sm.DIMENSIONS:
        rows = [r for r in report if r.dimension == d]
        assert sum(r.target for r in rows) == pytest.approx(1, abs=1e-9)
        assert all(abs(r.reached - r.target) <= 1e-3 for r in rows), rows


def test_bounded_raking(spark):
    """A source that is asked for more than it has gives all; the others take the rest."""
    rng = np.random.default_rng(9)
    cells = [(s, g, t, int(rng.integers(50, 500))) for s, g, t in itertools.product("=a =b =c".split(), "=x =y".split(), [0, 1, 2])]
    df = spark.createDataFrame(cells, "_source string, _lang string, _topic int, tokens long")
    total, of_a = sum(c[3] for c in cells), sum(c[3] for c in cells if c[0] == "=a")
    share = {"source": spark.createDataFrame([("a", 0.9), ("b", 0.05), ("c", 0.05)], "source string, share double")}
    chances, aims = sm.cell_chances(df, share, budget=0.6)
    rows = chances.collect()
    assert all(0 <= r.probability <= 1 for r in rows)
    mass = lambda f: sum(r.tokens * r.probability for r in rows if f(r)) / (0.6 * total)
    assert mass(lambda r: True) == pytest.approx(1, abs=1e-3)
    assert mass(lambda r: r._source == "=a") == pytest.approx(of_a / (0.6 * total), abs=1e-3)
    assert all(r.probability == pytest.approx(1, abs=1e-2) for r in rows if r._source == "=a")
    assert mass(lambda r: r._source == "=b") == pytest.approx(mass(lambda r: r._source == "=c"), abs=1e-3)
    for d in sm.DIMENSIONS:
        for t in aims[d].collect():
            assert mass(lambda r: r[f"_{d}"] == t[f"_{d}"]) == pytest.approx(t.target, abs=2e-3), (d, t)


def test_unreachable_target_is_reported(spark):
    docs = [(i, "some words of this text " * 5, "rare" if i < 10 else "s", "en") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    share = spark.createDataFrame([("rare", 0.5), ("s", 0.5)], "source string, share double")
    by = {r.value: r for r in sm.mix_report(df, {"source": share}, budget=0.5).collect() if r.dimension == "source"}
    assert not by["rare"].reachable and by["rare"].wanted == pytest.approx(0.5) and by["rare"].reached == pytest.approx(0.2, abs=1e-3)
    assert by["s"].reached == pytest.approx(0.8, abs=1e-3)


def test_topics_follow_the_words(spark):
    rng = np.random.default_rng(2)
    words = [[f"{chr(97 + k)}{chr(97 + j % 26)}{chr(97 + j // 26)}word" for j in range(60)] for k in range(4)]
    docs = [(i, " ".join(rng.choice(words[i % 4], 40)), i % 4) for i in range(200)] + [(900, "a b 1234567", 9), (901, None, 9)]
    df = spark.createDataFrame([(i, t, "s", "en", k) for i, t, k in docs], "doc_id long, text string, source string, lang string, k int")
    rows = sm.describe(df, sm.fit_topics(df)).collect()
    seen = {(r.k, r._topic) for r in rows if r.k < 4}
    assert len({t for _, t in seen}) == len(seen)  # no topic mixes two word lists
    assert [r._topic for r in rows if r.k == 9] == [sm.TOPICS] * 2
    assert {r.doc_id: r._tokens for r in rows}[900] == 3


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "longer words " * 300_000, "s", "en"), (2, "x", "s", "en")], "doc_id long, text string, source string, lang string")
    assert {r.doc_id: r._tokens for r in sm.mixed(df).collect()} == {1: 600_000, 2: 1}


def test_topics_are_fitted_on_every_text(spark):
    """A subject of 40 among 6,000 texts has a topic of its own, whatever the hashes of its texts,
    and the centres are the same however the rows are dealt out."""
    rng = np.random.default_rng(7)
    words = [[f"{chr(97 + k)}{chr(97 + j % 26)}{chr(97 + j // 26)}word" for j in range(60)] for k in range(3)]
    docs = [(i, " ".join(rng.choice(words[k], 30)), k) for i in range(6000) for k in [2 if i % 150 == 0 else i % 2]]
    df = spark.createDataFrame(docs, "doc_id long, text string, k int")
    counted = sm.written(sm.word_counts(df), "counted")
    seen = []
    texts = sm._different(counted, "text")
    assert sm._summed(texts, 1, lambda block: len(block.sizes))[0] == 6000  # no text is left out
    centres = sm.topic_centres(texts, rounds=3)
    for parts in (1, 5):
        seen.append(sm.topic_centres(sm.written(texts.repartition(parts), "dealt"), rounds=3))
    assert all((c == centres).all() for c in seen)
    cells = {k: {i for w in words[k] for i in sm.topic_counts(w)[1].tolist()} for k in range(3)}
    rare = sorted(cells[2] - cells[0] - cells[1])
    assert (centres[rare] > 0).any(1).all()  # every word of the rare subject has weight in a centre


def test_fit_reads_no_part_of_the_corpus_alone(spark):
    """A word that one text of 5,000 has is in the centres (a fit on some texts would miss most such words)."""
    docs = [(i, f"common words here unique{''.join(chr(97 + int(c)) for c in str(i))}") for i in range(5000)]
    centres = sm.fit_topics(spark.createDataFrame(docs, "doc_id long, text string"))
    held = {int(c) for _, t in docs for c in sm.topic_counts(t)[1]}
    assert [c for c in held if not centres[c].any()] == [c for c in held if c in set(sm.topic_counts("common words here")[1].tolist())]


def test_raking_in_a_task_equals_the_distributed_sweeps(spark, monkeypatch):
    rng = np.random.default_rng(11)
    cells = [(s, g, t, int(rng.integers(1, 500)), float(rng.uniform(0.004, 0.2))) for s, g, t in itertools.product("abcd", "xy", [0, 1, 2])]
    df = spark.createDataFrame(cells, "_source string, _lang string, _topic int, tokens long, cap double")
    want = {"source": {"a": 0.2, "b": 0.4, "c": 0.3, "d": 0.1}, "lang": {"x": 0.6, "y": 0.4}, "topic": {0: 0.1, 1: 0.3, 2: 0.6}}
    kinds = {"source": "string", "lang": "string", "topic": "int"}
    targets = {d: spark.createDataFrame(list(v.items()), f"_{d} {kinds[d]}, target double") for d, v in want.items()}
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rake", "in a task")
    here = {r[:4]: r.weight for r in sm.rake(df, targets, sweeps=6, tolerance=0.0).collect()}
    assert len(jobs.getJobIdsForGroup("rake")) < 20  # one job for all sweeps
    spark.sparkContext.setJobGroup("rest", "")
    monkeypatch.setattr(sm, "TASK_CELLS", 10)
    there = {r[:4]: r.weight for r in sm.rake(df, targets, sweeps=6, tolerance=0.0).collect()}
    assert here.keys() == there.keys() and all(here[k] == pytest.approx(there[k], rel=1e-9, abs=1e-15) for k in here)
