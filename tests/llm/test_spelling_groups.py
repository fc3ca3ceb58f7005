"""Words, near words, forms and roots against a plain dictionary version."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from conftest import SF001
from shelfwise.llm import spelling_groups as sg


def brute_counts(rows, min_chars=5, min_count=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}


def brute_groups(n, ratio=2):
    near, pattern = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            pattern[w[:i], w[i + 1:]].add(w)
            shorter = w[:i] + w[i + 1:]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in pattern.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= ratio * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def got(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    want = brute_groups(brute_counts(rows))
    assert got(sg.op11_spelling_groups(spark, SF001)) == want
    assert sum(w[1] is not None for w in want) > 100
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    assert sorted(con.execute(sg.ORACLE_SQL).fetchall()) == want


def test_words_of_hard_texts(spark):
    rows = [(k, "Straße STRASSE naïve×naïve ÉCOLE école don't x2x \U0001f600emoji") for k in range(300)]
    rows += [(None, "Hello hello hello hello"), (7, None), (8, ""), (9, "12 345 中文"), (3, rows[3][1]), (10, "a" * 200_000 + " " + "b" * 100)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    have = {r["word"]: r["n"] for r in sg.vocabulary(sg.occurrences(df)).collect()}
    assert have == brute_counts(rows)
    assert "École" in have and "straße" in have  # only A-Z are lower-cased


@pytest.mark.parametrize("filter_bytes", [sg.FILTER_BYTES, 1])
def test_groups_of_any_words(spark, monkeypatch, filter_bytes):
    """With a bound of one byte, each chunk of the filter is a pass of its own."""
    monkeypatch.setattr(sg, "TASK_WORDS", 500)
    monkeypatch.setattr(sg, "CHUNK_BLOCKS", 16)
    rng = np.random.default_rng(5)
    n = {}
    for _ in range(700):  # three letters: dense neighbourhoods, repeated letters, chains of forms
        n["".join(rng.choice(list("abÿ"), rng.integers(5, 9)))] = int(rng.integers(3, 2000))
    tail = "q" * 3000
    n |= {"hot" + tail: 9, "hat" + tail: 4, "ha" + tail: 4, "hot" + tail + "s": 20, "z" * 64: 3, "z" * 65: 6, "z" * 66: 12, "aaaaa": 3, "aaaaaa": 6}
    df = spark.createDataFrame([(w, c, 1) for w, c in n.items()], "word string, n long, near int")
    want = brute_groups(n)
    assert got(sg.spelling_groups(df, filter_bytes=filter_bytes)) == want
    assert any(w[1] and w[2] != w[1] for w in want)


def test_ties_and_empty(spark):
    n = {"caten": 3, "cater": 6, "catek": 6, "water": 5}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    have = got(sg.spelling_groups(df))
    assert have == brute_groups(n)
    assert ("caten", "catek", "catek", 3, 2, 6) in have
    assert got(sg.spelling_groups(df.limit(0))) == []


def test_few_false_positives():
    rng = np.random.default_rng(6)
    words = list({"".join(rng.choice(list(sg.ALPHABET), 9)) for _ in range(20_000)})
    layout = sg.Layout({9: len(words)})
    (_, codes), = sg._by_length(words, 1 << 24)
    h = sg._mix((sg._letters(codes) * sg._powers(9)).sum(1, dtype="u8"))
    bits = np.zeros((layout.total, sg.BLOCK_WORDS), "u8")
    for k in range(sg.BLOCK_WORDS):
        np.bitwise_or.at(bits[:, k], layout.block(h, 9), np.uint64(1) << sg._bits(h)[:, k])
    assert len(sg._may_hold(bits, 0, layout, h, 9)[0]) == len(words)
    others = sg._mix(rng.integers(0, 1 << 62, 1_000_000).astype("u8"))
    assert len(sg._may_hold(bits, 0, layout, others, 9)[0]) < 3000
