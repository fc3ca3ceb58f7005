"""Packing against the whole tokenizer and the layout rules."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF001
from shelfwise.llm import best_fit_packing as bp

ODD = ["", None, "   \n ", "Ünï cödé ΣΑΣ İstanbul", "a\x1cb!\x1c! c", "x\xa0y z　q\x85r", "don't we'll I'm",
       "<|endoftext|> a<|startoftext|>b", "é combining", "12345 6.7 $$$%%% THE!! end", "\U0001F600 smile"]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(bp.vocabulary_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def check_layout(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_ids_pieces_and_layout(spark, whole):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    docs = docs.unionByName(odd).unionByName(odd.limit(3))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = bp.pack_documents(docs, bp.vocabulary_path(), capacity=256).collect()
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.piece), (r.start, r.length, bytes(r.ids)))
    want = {}
    for doc, text in texts:
        ids = whole(text)
        for k in range(0, len(ids), 256):
            want[doc, k // 256] = (k, len(ids[k:k + 256]), np.asarray(ids[k:k + 256], "<u4").tobytes())
    assert got == want
    assert len(rows) == sum(-(-len(whole(t)) // 256) for _, t in texts)
    n = check_layout(rows, 256)
    assert n <= math.ceil(sum(r.length for r in rows) / 256) * 1.02 + 1


def test_query_columns(spark, whole):
    df = bp.op6_best_fit_packing(spark, SF001)
    assert df.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = df.collect()
    check_layout(rows, 4096)
    for r in rows[::7]:
        ids = whole(text[r.doc_id])[r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 97, 256])
    hist = {n: rnd.randint(0, 40) for n in range(1, capacity + 1) if rnd.random() < 0.6}
    rows = []
    for length, first, count, seq, offset, per in bp.plan_sequences(hist, capacity):
        rows += [{"length": length, "rank": first + i, "sequence_id": seq + i // per,
                  "offset": offset + i % per * length} for i in range(count)]
    assert sorted((r["length"], r["rank"]) for r in rows) == [(n, i) for n in sorted(hist) for i in range(hist[n])]
    n = check_layout(rows, capacity)
    large = sum(c for k, c in hist.items() if 3 * k > capacity)
    assert n <= max(math.ceil(1.25 * sum(k * c for k, c in hist.items()) / capacity) + 1, large)


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, length string, offset int")
    assert bp.pack_documents(empty, bp.vocabulary_path()).count() == 0
    one = empty.union(spark.createDataFrame([(None, "a b", "x", 1)], empty.schema))
    out = bp.pack_documents(one, bp.vocabulary_path()).withColumn("n", F.length("ids")).collect()
    assert [(r.doc_id, r.length, r.n, r.offset) for r in out] == [(None, 3, 12, 0)]
