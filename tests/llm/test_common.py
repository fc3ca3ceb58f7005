"""Shared helpers."""

import random
import sys

import pandas as pd
from pyspark.sql import functions as F

from shelfwise.llm import common


def test_connected_components_equal_union_find(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(40)] \
        + [(2000, 2000 + i) for i in range(50)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in common.connected_components(
        spark.createDataFrame(edges, "u long, v long"), "test").collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in touched}
    assert common.connected_components(spark.createDataFrame([], "u long, v long"), "test").count() == 0


def test_whole_groups_across_batches():
    frames = [pd.DataFrame({"k": k, "v": v}) for k, v in (([1, 1, 2], [0, 1, 2]), ([2, 2], [3, 4]), ([], []), ([2, 3], [5, 6]))]
    assert [g["v"].tolist() for g in common.whole_groups(iter(frames), ["k"])] == [[0, 1], [2, 3, 4, 5], [6]]
    assert list(common.whole_groups(iter([]), ["k"])) == []


def test_words_and_own_names(spark):
    df = spark.createDataFrame([("a\tb  c\x0b",), (" \n",), (None,), ("é\xa0x",)], "t string")
    assert [r.w for r in df.select(common.words_of(F.col("t")).alias("w")).collect()] == [["a", "b", "c"], [], [], ["é\xa0x"]]
    clash = spark.createDataFrame([(1, 2)], "in_1 int, x int")
    out = common.in_own_names(clash, lambda d, col: d.withColumn("x", F.lit(9)).withColumn(col, F.col(col) + 1), col="x")
    assert out.columns == ["in_1", "x"] and tuple(out.first()) == (1, 3)


def test_lowest_keys_reads_few_rows(spark):
    df = spark.range(100_000).select("id", F.xxhash64(F.col("id") % 60_000).alias("h"))
    keys = sorted({r.h for r in df.select("h").collect()})
    assert [r.h for r in common.lowest_keys(df, "h", 500).collect()] == keys[:500]
    assert common.lowest_keys(df.limit(30), "h", 500).count() == 30
    assert common.lowest_keys(df.limit(0), "h", 500).count() == 0


def test_a_worker_holds_the_state_of_one_operator():
    """Caches of the stages that a reused Python worker served don't add up."""
    made = []
    make = lambda x: lambda: made.append(x) or [x]
    common.drop_worker_state()
    assert common.worker_state("a:1", make(1)) == common.worker_state("a:1", make(9)) == [1]
    common.worker_state("a:2", make(2))
    common.worker_state("a:1", make(9))  # states of one operator stay together
    assert made == [1, 2]
    common.worker_state("b", make(3))
    assert list(sys.modules["_shelfwise_worker_state"].kept) == ["b"]
    common.worker_state("a:1", make(4))
    assert made == [1, 2, 3, 4]
    common.drop_worker_state()
    assert not sys.modules["_shelfwise_worker_state"].kept
