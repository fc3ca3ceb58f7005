"""Components, whitened values and exact deviations against numpy's eigh."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from shelfwise.llm import whitening as wh


def brute(rows, components=16):
    usable = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
              if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], "f8") / n
    cov = centred.T @ centred / n
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    out = {}
    for i, x in usable:
        off = [n * a - s for a, s in zip(x, sums)]
        out.setdefault(i, []).append((n, sum(d * d for d in off), (np.array(off) / n) @ vector / np.sqrt(value)))
    return out, value / np.trace(cov)


def check(df, rows, tolerance=1e-7):
    want, explained = brute(rows)
    have = {}
    for r in df.collect():
        have.setdefault(r["vec_id"], []).append(r)
    assert set(have) == set(want)
    errors = {r["identity_error"] for rs in have.values() for r in rs}
    assert len(errors) == 1 and errors.pop() < 1e-9
    signs = None
    for i, rs in have.items():
        k, copies = len(explained), len(want[i])
        assert len(rs) == k * copies
        n, deviation, whitened = want[i][0]
        assert {(r["n"], r["deviation"]) for r in rs} == {(n, deviation)}
        by = {}
        for r in rs:
            assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
            by.setdefault(r["component"], set()).add(r["whitened"])
        assert sorted(by) == list(range(1, k + 1)) and all(len(v) == 1 for v in by.values())
        mine = np.array([by[c].pop() for c in range(1, k + 1)])
        if signs is None and (abs(whitened) > 1e-3).all():
            signs = np.sign(mine * whitened)
        if signs is not None:
            assert np.allclose(mine, signs * whitened, atol=tolerance)
    assert signs is not None


def test_query_equals_eigh(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(wh.op12_embedding_whitening(spark, SF001), rows)


def test_bad_rows_repeats_and_wide_scales(spark, monkeypatch):
    monkeypatch.setattr(wh, "STEP_ENTRIES", 64)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((200, 20)) * np.geomspace(1, 1e3, 20) + 1e4
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(300, rows[0][1]), (0, rows[0][1])] + [(400 + k, rows[1][1]) for k in range(150)]
    rows += [(500, None), (501, [None] * 20), (502, [float("nan")] * 20), (503, [float("inf")] * 20), (504, []), (505, rows[2][1][:-1] + [None])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, x int").repartition(5)
    check(wh.whitened(df), rows)


def test_rank_and_lengths(spark):
    rng = np.random.default_rng(4)
    two = rng.integers(-50, 50, (60, 2)) / 64
    rows = [(k, [a, b, a + b, 1.0, -a]) for k, (a, b) in enumerate(two.tolist())] + [(900, [1.0, 2.0]), (901, [1.0])]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")
    have = wh.whitened(df)
    assert {r["component"] for r in have.collect()} == {1, 2}
    assert have.filter("vec_id >= 900").isEmpty()
    assert have.agg(F.max("identity_error")).head()[0] < 1e-9
    assert have.filter("component = 1 OR component = 2").select("component", "explained").distinct().agg(F.sum("explained")).head()[0] == pytest.approx(1)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])] * 3])
def test_nothing_to_fit(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = wh.whitened(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.isEmpty()


def test_huge_entries_do_not_fail(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    out = wh.whitened(df).collect()
    assert len(out) == 3 * max(r["component"] for r in out) and all(np.isfinite(r["whitened"]) for r in out)
    assert {r["deviation"] for r in out} == {None, 576 ** 2}  # 3 * 320 - (64 + 320)


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_factors(d):
    rng = np.random.default_rng(d)
    b = rng.standard_normal((d, d)) * np.geomspace(1e-3, 1e3, d)
    a = b.T @ b
    low = wh.pivoted_cholesky(a)
    assert np.allclose(low @ low.T, a, rtol=1e-10, atol=1e-12 * a.max())
    value, vector = wh.one_sided_jacobi(low)
    assert (np.diff(value) <= 0).all()
    assert np.allclose(vector.T @ vector, np.eye(len(value)), atol=1e-10)
    assert np.allclose((vector * value) @ vector.T, a, atol=1e-12 * a.max())
