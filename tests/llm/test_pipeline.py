"""Every pipeline stage against a plain version of it on the stage's own input."""

import pytest

import corpus_pipeline as cp
from conftest import SF01
from shelfwise.llm import best_fit_packing as bp
from shelfwise.llm import quality_gam as qg
from shelfwise.llm import source_mixing as sm
from shelfwise.llm.common import read_table, written
from test_best_fit_packing import check_layout
from test_minhash_dedup import brute
from test_pii_disclosure import base


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read_table(spark, SF01, "documents"), []
    for name, stage in cp.STAGES:
        after = written(stage(spark, docs, SF01), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def test_columns(stages):
    for docs, after in stages[:-1]:
        assert after.dtypes == stages[0][0].dtypes


def test_quality(spark, stages):
    docs, after = stages[0]
    ids = {r.doc_id for r in after.select("doc_id").collect()}
    labels = [(r.doc_id, r.quality) for r in read_table(spark, SF01, "labels").collect()]
    assert sum((d in ids) == (q == 1) for d, q in labels) / len(labels) > 0.97
    model = qg.fit_quality_model(docs, read_table(spark, SF01, "labels"))
    assert ids == {r.doc_id for r in docs.collect() if model.score(qg.features_of(r.text)[None])[0] >= 0.5}


def test_near_dedup(stages):
    docs, after = stages[1]
    want = {d for d, (_, _, kept) in brute([(r.doc_id, r.text) for r in docs.collect()], 5).items() if kept}
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == sorted(want)


def test_personal_data(stages):
    docs, after = stages[2]
    texts = {r.doc_id: r.text for r in after.collect()}
    assert len(texts) == docs.count()
    for r in docs.collect():
        assert not base(texts[r.doc_id])
        if not base(r.text):
            assert texts[r.doc_id] == r.text


def test_mix(stages):
    docs, after = stages[3]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in sm.mixed(docs).filter("_sampled").collect()}
    assert 0.6 < after.count() / docs.count() < 0.95


def test_packing(spark, stages):
    docs, after = stages[4]
    encode = bp.Encoder(bp.vocabulary_path())
    rows = after.collect()
    assert {(r.doc_id, r.piece) for r in rows} == {
        (d.doc_id, k) for d in docs.collect() for k in range(-(-(len(encode(d.text)) // 4 + 1) // 4096))}
    check_layout(rows, 4096)


def test_run_is_the_stages_applied(spark, stages):
    assert sorted(map(tuple, cp.run(spark, SF01).drop("sequence_id", "offset").collect())) == sorted(
        map(tuple, stages[-1][1].drop("sequence_id", "offset").collect()))
    assert cp.ORACLE_SQL is None


def test_empty_documents_and_repeated_rows(spark):
    docs = read_table(spark, SF01, "documents")
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        after = stage(spark, empty, SF01)
        assert after.count() == 0
        empty = after if after.columns == docs.columns else empty
    two = docs.filter("doc_id < 20")
    assert cp.minhash_near_dedup(spark, two.union(two), SF01).count() == cp.minhash_near_dedup(spark, two, SF01).count()


def test_rows_without_an_id_and_one_id_with_two_texts(spark):
    def text(name, last="end"):
        return " ".join(f"{name}{i}" for i in range(60)) + f" {last}"

    rows = [(None, text("a")), (None, text("b")), (None, text("b", "tail")), (None, text("b")), (7, text("c")), (7, text("d")),
            (7, text("d")), (8, text("d", "tail")), (None, text("c", "tail")), (None, ""), (9, ""), (10, " "), (10, None)]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    blanks = spark.createDataFrame([(None, None, "a"), (None, None, "b"), (None, None, "c"), (4, "", "a"), (4, "", "b"), (4, "", "b")], df.schema)
    assert cp.minhash_near_dedup(spark, blanks, SF01).count() == 5  # only the equal rows become one
    after = cp.minhash_near_dedup(spark, df, SF01)
    assert after.columns == df.columns
    got = sorted(((r.doc_id, (r.text or "")[:1].strip()) for r in after.collect()), key=repr)
    assert got == sorted([(None, "a"), (None, "b"), (7, "c"), (7, "d"), (None, ""), (9, ""), (10, ""), (10, "")], key=repr)
    assert sorted(map(tuple, cp.minhash_near_dedup(spark, df.orderBy("text").repartition(3), SF01).collect()), key=repr) == sorted(
        map(tuple, after.collect()), key=repr)


def test_rows_without_an_id_are_drawn_apart(spark):
    df = spark.createDataFrame([(None, f"some words number {i}", "s", "en") for i in range(300)],
                               "doc_id long, text string, source string, lang string")
    assert 0 < sm.sample_mix(df, budget=0.5).count() < 300
