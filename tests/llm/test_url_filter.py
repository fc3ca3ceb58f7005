"""Rules against plain code; the model on URLs whose rule was hidden."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from shelfwise.llm import url_filter as uf

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    best = max(((len(r), r, v) for v, r in RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0]))
                and path.startswith("/" + r.split("/", 1)[1])), default=(0, None, None))
    return host, path, best[1], best[2]


def test_query(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    df = uf.op8_url_filter(spark, SF01)
    assert df.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = df.collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
    free = [r for r in rows if r.rule is None]
    assert free and {r.verdict for r in free} <= {"block", "allow"}


HARD = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x", "x://net", "x://net/", "http://net?u=/", "ftp://b.net#/",
        "http://exampleXnet/", "http://myexample.net/en/", "http://example.com/de/1", "http://example.com/de", "http://w.org/fr/a://b",
        "http://É.Org/fr/", "http://a b.net\n/en/?q=1&r=2#f", "http://x.io/" + "a1/" * 20_000, "://x.net/y"]


def test_rules_features_and_cases(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(HARD)] + [(1, "", "h")], "page_id long, url string, _x string")
    rows = uf.judge_urls(df).collect()
    assert len(rows) == len(HARD) + 1
    for r in rows:
        host, path, rule, verdict = plain(r.url)
        assert (r._host, r._path, r._rule) == (host, path, rule), r.url
        assert r._verdict == (verdict or r._verdict)
    for r in uf.lexical(df).collect():
        n = Counter(r.url or "")
        total = sum(n.values())
        want = -sum(c / total * math.log2(c / total) for c in n.values()) if total else 0.0
        assert r._entropy == pytest.approx(want, abs=1e-9) and r._digits == sum(c.isdigit() for c in r.url or "")
    assert {r._verdict for r in uf.judge_urls(df.filter("page_id = 2")).collect()} == {"allow"}
    assert {r._verdict for r in uf.judge_urls(df.filter("page_id in (2, 6)")).collect()} == {"block"}
    assert uf.judge_urls(df.limit(0)).count() == 0


def test_model_finds_hidden_labels(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url")
    rules = [("block", "ads.example.com", "/"), ("allow", "example.com", "/")]
    made = spark.range(600).select(F.col("id").alias("page_id"), F.when(
        F.col("id") % 2 == 0, F.concat(F.lit("http://ads.example.com/click?id="), F.col("id"), F.lit("&a=1&b=2&c=3&d=4")))
        .otherwise(F.concat(F.lit("http://www.example.com/story-"), F.col("id"))).alias("url"))
    other = spark.range(40).select((F.col("id") + 1000).alias("page_id"), F.when(
        F.col("id") % 2 == 0, F.concat(F.lit("http://shop.test/click?id="), F.col("id"), F.lit("&a=1&b=2&c=3&d=4")))
        .otherwise(F.concat(F.lit("http://shop.test/story-"), F.col("id"))).alias("url"))
    got = uf.judge_urls(made.unionByName(other), rules=rules).filter("page_id >= 1000").collect()
    assert sum((r._verdict == "block") == (r.page_id % 2 == 0) for r in got) >= 38
    assert pages.count() > 0


def test_own_label_is_no_feature(spark):
    """Suffix shares of a fitted URL come from the hosts of other folds."""
    pages = spark.createDataFrame([(i, f"http://h{i % 9}.{'net' if i % 2 else 'org'}/fr/{i}") for i in range(180)], "page_id long, url string")
    labelled = uf._labelled(pages, "url", uf.RULES)
    shares, prior = uf.suffix_shares(labelled)
    rows = [(r._host, r._fold, r._listed) for r in labelled.collect()]
    for r in uf._with_shares(labelled, shares, prior).collect():
        others = [v for h, f, v in rows if f != r._fold and h.endswith(r._last_label)]
        want = (others.count("block") + uf.SMOOTH * prior) / (len(others) + uf.SMOOTH)
        assert r._share_last_label == pytest.approx(want)


def test_loss_on_unseen_hosts(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url")
    report = uf.held_out_report(pages)
    assert report["rows"] > 0 and report["loss"] < 0.5 * report["plain_loss"] and report["accuracy"] > 0.9
