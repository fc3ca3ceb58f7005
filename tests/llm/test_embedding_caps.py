"""Links, components and recall against brute force over all pairs."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from shelfwise.llm import embedding_caps as ec


def brute(rows, cosine=0.93):
    usable = {}
    for i, (vec_id, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = np.asarray(v, "f8") / np.linalg.norm(np.asarray(v, "f8"))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in usable:
        for j in usable:
            if i < j and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, r in enumerate(rows):
        ids = [x for x in (low.get(find(i)), r[0]) if x is not None]
        low[find(i)] = min(ids) if ids else None
    return sorted(((r[0], links[i], low[find(i)], r[0] == low[find(i)]) for i, r in enumerate(rows)), key=repr)


def near(rng, v, cos):
    w = rng.standard_normal(len(v))
    w -= w @ v * v
    return cos * v + np.sqrt(1 - cos * cos) * w / np.linalg.norm(w)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(ec.op3_embedding_caps(spark, SF01)) == brute(rows)


def test_planted_links_hot_group_and_cases(spark, monkeypatch):
    monkeypatch.setattr(ec, "BLOCK", 16)  # many blocks for the hot group
    rng = np.random.default_rng(2)
    unit = lambda v: v / np.linalg.norm(v)
    rows = []
    for k in range(150):
        v = unit(rng.standard_normal(64))
        rows.append((k, v.tolist(), k % 3))
        rows.append((1000 + k, (5 * near(rng, v, 0.945 + 0.05 * rng.random())).tolist(), k % 3 if k % 10 else 7))
    hot = unit(rng.standard_normal(64))
    rows += [(2000 + k, near(rng, hot, 0.985).tolist(), 1) for k in range(120)]
    rows += [(3000, rows[0][1], 0)] * 3 + [(None, rows[2][1], 1), (3001, None, 1), (3002, [0.0] * 64, 1), (3003, rows[0][1], None),
             (3004, [float("nan")] * 64, 1), (3005, [None] * 64, 1), (3006, [], 1), (3007, [1.0, 2.0], 1), (3008, [2.0, 4.0], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    want, have = brute(rows), got(ec.near_duplicate_vectors(df))
    assert [r[0] for r in want] == [r[0] for r in have]
    missed = sum(w[1] - h[1] for w, h in zip(want, have))
    assert 0 <= missed <= 0.005 * sum(w[1] for w in want)
    assert sum(w != h for w, h in zip(want, have)) <= 4
    assert ec.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1_000, 10_000, 100_000, 1_000_000])
def test_recall_at_the_threshold(n):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.stack([near(rng, v, 0.93) for v in x])
    a, b = ec.decode(x, n), ec.decode(y, n)
    found = np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)])
    assert found >= 0.99, found
    assert ec.LEAST <= np.mean([len(p) for p in a]) < 1.5 * ec.LIST
    if n <= 100_000:  # a direction holds a constant number of vectors
        words, share = ec.code_size(n)
        assert n * np.mean([len(p) for p in a]) / words ** 2 < 2 * max(ec.PER_DIRECTION, ec.LARGEST_CAP * n)


def test_list_decoding_is_complete():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((20, 9))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    words, share = ec.code_size(20_000)
    rotation, parts = ec.codebook(9, words)
    need = ec.cap_threshold(share, 9) * np.sqrt(2)
    scores = [(x @ rotation)[:, p] @ w.T for p, w in zip(np.array_split(np.arange(9), 2), parts)]
    every = (scores[0][:, :, None] + scores[1][:, None, :]).reshape(20, -1)
    for codes, sums in zip(ec.decode(x, 20_000), every):
        want = np.flatnonzero(sums >= need)
        assert list(codes) == list(want) if len(want) >= ec.LEAST else sorted(sums[codes]) == sorted(np.sort(sums)[-ec.LEAST:])


def test_cap_threshold():
    rng = np.random.default_rng(5)
    for dim in (2, 3, 16, 64):
        x = rng.standard_normal((400_000, dim))
        cosine = x[:, 0] / np.linalg.norm(x, axis=1)
        for share in (0.01, 0.002):
            assert (cosine > ec.cap_threshold(share, dim)).mean() == pytest.approx(share, rel=0.15)


def test_sql_equals_brute_force_on_planted_links(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(60):
        v = rng.standard_normal(16)
        v /= np.linalg.norm(v)
        rows += [(k, v.tolist(), k % 2), (100 + k, near(rng, v, 0.96).tolist(), k % 2), (200 + k, near(rng, v, 0.95).tolist(), 1)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, rows[0][1], None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    sql = con.execute(ec.ORACLE_SQL).fetchall()
    assert sorted(sql, key=repr) == brute(rows) and sum(r[1] for r in sql) > 100
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(ec.near_duplicate_vectors(df)) == brute(rows)
