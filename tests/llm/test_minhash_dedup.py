"""Near-duplicates against a brute-force comparison of all pairs that share a shingle."""

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from conftest import SF01, SF001
from shelfwise.llm import minhash_dedup as md


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def brute(rows, size, percent=80):
    sets = {}
    for doc, text in rows:
        w = words(text)
        sets[doc] = frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    holders = defaultdict(list)
    for doc in sorted(sets):
        for s in sets[doc]:
            holders[s].append(doc)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    shared = defaultdict(int)
    for docs in holders.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1:]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    have = result(md.op2_minhash_dedup(spark, sf_dir))
    assert have == brute(rows, 4)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    assert {r[0]: r[1:] for r in con.execute(md.ORACLE_SQL).fetchall()} == have


def test_ids_that_carry_two_texts(spark):
    def text(name, last=""):
        return " ".join(f"{name}{i}" for i in range(60)) + last

    rows = [(1, text("a")), (1, text("b")), (2, text("a", " x")), (3, text("b", " x")), (None, text("c")), (None, text("c", " x")), (4, text("d"))]
    out = md.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=4)
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in out.collect()), key=repr) == sorted(
        [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (None, None, True), (None, None, True), (4, 4, True)], key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_large_buckets_of_several_components(spark, monkeypatch, seed):
    """Sets around the threshold: buckets hold many components that pivots alone don't link."""
    monkeypatch.setattr(md, "BLOCK_DOCS", 16)
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for k in range(160):
        words = list(base)
        for _ in range(rnd.choice([1, 2, 3])):
            words[rnd.randrange(80)] = f"n{k % 40}"
        rows.append((k, " ".join(words)))
    got = result(md.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=4))
    assert got == brute(rows, 4)
    assert len({c for _, c, _ in got.values()}) > 1


def test_cases(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rnd = random.Random(3)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "ONE Two"), (5, "one two three"), (6, base),
            (7, base.upper()), (8, base + " x y"), (9, "one two"), (40, "É é"), (41, "é é")]
    chain = base.split()
    for k in range(10, 30):  # a chain whose ends differ
        chain[rnd.randrange(len(chain))] = f"n{k}"
        rows.append((k, " ".join(chain)))
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, component_id string, n int")
    got = result(md.near_duplicates(df, shingle_words=4))
    assert got == brute(rows, 4)
    again = df.union(df)
    assert result(md.near_duplicates(again, shingle_words=4)) == got
    assert md.near_duplicates(again, shingle_words=4).count() == 2 * len(rows)
    assert md.near_duplicates(df.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, "z")], "doc_id long, text string")
    assert sorted(map(tuple, md.near_duplicates(nulls).collect()), key=repr) == [
        (3, 2, 3, True), (None, 1, None, True), (None, 2, 3, False)]
    tall = spark.createDataFrame([(1, "lorem ipsum " * 100_000 + "end"), (2, "ipsum lorem " * 100_000)], "doc_id long, text string")
    assert result(md.near_duplicates(tall, shingle_words=4)) == brute([tuple(r) for r in tall.collect()], 4)


def test_estimate_is_close_and_corrected():
    rng = np.random.default_rng(5)
    chance = md.chance_agreements()
    for n, share in ((400, 0.8), (4000, 0.5), (100_000, 0.0)):
        both = int(share * 2 * n / (1 + share))
        pool = rng.integers(0, 2**63, 2 * n, dtype="u8") * np.uint64(2)
        a, b = np.unique(pool[:n]), np.unique(pool[n - both:2 * n - both])
        ra, rb = md.registers_of(a)[None], md.registers_of(b)[None]
        est, sd = md.estimated_jaccard(ra, rb, np.array([len(a)]), np.array([len(b)]), chance)
        assert abs(est[0] - share) < 5 * sd[0]
    assert 0 < chance[20, 20] < 0.5 and chance[0, 40] < chance[40, 40]


def test_very_small_sets_share_a_band():
    rng = np.random.default_rng(11)
    sets = [np.unique(rng.integers(0, 2**63, 5, dtype="u8") * np.uint64(2)) for _ in range(4000)]
    a = md.band_keys(np.stack([md.registers_of(s) for s in sets]))
    b = md.band_keys(np.stack([md.registers_of(np.delete(s, i % 5)) for i, s in enumerate(sets)]))
    assert ((a == b).any(1)).all()
