"""URL filter: listed rules, and boosted trees for the URLs no rule covers.

A rule is a host and a path prefix; it fits the host and all its subdomains where
the URL's path starts with the prefix, and the longest fitting rule decides.  The
URLs that a rule decides are the labelled ones: gradient-boosted trees learn from
their lexical features which other URLs to block.

Features: lengths of URL, host and path, path depth, host labels, digit and hyphen
counts, digit ratio, character entropy, numbers of query parameters and of
characters after ``#``, and suffix statistics: the smoothed share of blocked URLs
among the labelled ones with the same last label, last two labels, and first path
segment.  The trees are fitted on at most ``MAX_FIT_ROWS`` labelled URLs (those of
smallest hash, repeated URLs once); the suffix statistics cover all labelled URLs, and
every URL is judged.  Hosts are dealt into ``FOLDS`` by a hash, and a URL that is fitted
takes its statistics from the other folds, so its own label is not among its features and the
trees learn what the statistics tell of a host they have not seen.  ``held_out_report``
fits without one fold and measures the loss on it.

Defined cases: NULL URLs and URLs without ``://`` have an empty host and path and
are judged by the model like others; without labelled URLs everything not listed is
allowed, and with labels of one kind that kind is the verdict; URLs of any length are
read whole; of equally long rules the first in text order decides; repeated rows get
the same verdict; an empty table gives no row; other columns pass through, except those that start with ``_``,
which are dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import lowest_keys, read_table, written

#: (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_FIT_ROWS = 20_000
TREES, DEPTH, RATE = 10, 3, 0.3
SMOOTH = 20.0
FOLDS, ALL = 5, -1
FIT_PARTITIONS = 8  # of the bounded sample that every tree reads
SUFFIXES = ("last_label", "last_labels", "first_segment")
LEXICAL = ("url_chars", "host_chars", "path_chars", "path_depth", "host_labels", "digits", "hyphens", "digit_ratio",
           "entropy", "parameters", "fragment_chars")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (ties: the first in text order) and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):  # later ones win
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(act)).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.sort_array(F.split(text, ""))

    def runs(state, c):  # equal characters are neighbours
        same = c == state["last"]
        closed = F.when(state["run"] > 0, state["run"] * F.log2(F.greatest(state["run"], F.lit(1)).cast("double"))).otherwise(0.0)
        return F.struct(c.alias("last"), F.when(same, state["run"] + 1).otherwise(1).alias("run"),
                        F.when(same, state["sum"]).otherwise(state["sum"] + closed).alias("sum"))

    n = F.length(text)
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    total = F.aggregate(chars, start, runs, lambda s: s["sum"] + F.when(
        s["run"] > 0, s["run"] * F.log2(F.greatest(s["run"], F.lit(1)).cast("double"))).otherwise(0.0))
    return F.when(n > 0, F.log2(n.cast("double")) - total / n).otherwise(0.0)


def lexical(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with ``host, path, rule``, the rule's verdict, the lexical
    features and the suffix keys, in columns that start with ``_``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    seen = pages.withColumn("_url", url).withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    labels = F.split("_host", r"\.")
    query = F.regexp_extract("_url", r"(?s)^[^?#]*\?([^#]*)", 1)
    return seen.withColumns({
        "_rule": rule, "_listed": verdict,
        "_url_chars": F.length("_url"), "_host_chars": F.length("_host"), "_path_chars": F.length("_path"),
        "_path_depth": _count(F.col("_path"), "/"), "_host_labels": F.size(labels),
        "_digits": _count(F.col("_url"), "[0-9]"), "_hyphens": _count(F.col("_url"), "-"),
        "_digit_ratio": _count(F.col("_url"), "[0-9]") / F.greatest(F.length("_url"), F.lit(1)),
        "_entropy": _entropy(F.col("_url")),
        "_parameters": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "_fragment_chars": F.length(F.regexp_extract("_url", r"(?s)^[^#]*#(.*)$", 1)),
        "_last_label": F.element_at(labels, -1), "_last_labels": F.substring_index("_host", ".", -2),
        "_first_segment": F.regexp_extract("_path", "^/([^/]*)", 1), "_fold": F.lit(ALL)})


def suffix_shares(labelled: DataFrame) -> tuple[dict[str, DataFrame], float]:
    """For each suffix key its smoothed share of blocked labelled URLs, over ``ALL`` and
    over all folds but one; and the share of all, for a key without URLs there."""
    prior = labelled.agg(F.avg((F.col("_listed") == "block").cast("double"))).first()[0]
    out = {}
    for s in SUFFIXES:
        key = f"_{s}"
        folds = labelled.groupBy(key, "_fold").agg(F.count_if(F.col("_listed") == "block").alias("b"), F.count("*").alias("n"))
        folds = written(folds, f"url-{s}", narrow=True)
        sums = folds.groupBy(key).agg(F.sum("b").alias("all_b"), F.sum("n").alias("all_n"))
        others = folds.join(sums, key).select(key, "_fold", (F.col("all_b") - F.col("b")).alias("b"), (F.col("all_n") - F.col("n")).alias("n"))
        both = sums.select(key, F.lit(ALL).alias("_fold"), F.col("all_b").alias("b"), F.col("all_n").alias("n")).unionByName(others)
        share = (F.col("b") + F.lit(SMOOTH * prior)) / (F.col("n") + SMOOTH)
        out[s] = written(both.select(key, "_fold", share.alias(f"_share_{s}")), f"url-{s}", narrow=True)
    return out, prior


def _with_shares(urls: DataFrame, shares: dict[str, DataFrame], prior: float) -> DataFrame:
    return reduce(lambda df, s: df.join(shares[s], [f"_{s}", "_fold"], "left").withColumn(f"_share_{s}", F.coalesce(f"_share_{s}", F.lit(prior))),
                  SUFFIXES, urls)


def _features(urls: DataFrame, shares: dict[str, DataFrame], prior: float) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    inputs = [f"_{c}" for c in LEXICAL] + [f"_share_{s}" for s in SUFFIXES]
    return VectorAssembler(inputCols=inputs, outputCol="_x").transform(_with_shares(urls, shares, prior))


def _labelled(pages: DataFrame, url_col: str, rules) -> DataFrame:
    """The URLs a rule decides, with their host's fold."""
    slim = lexical(pages.select(F.col(url_col)), url_col, rules).drop(url_col).filter("_listed IS NOT NULL")
    return written(slim.withColumn("_fold", F.pmod(F.xxhash64("_host"), F.lit(FOLDS)).cast("int")), "url-labelled")


def fit_trees(labelled: DataFrame, shares: dict[str, DataFrame], prior: float, max_rows: int, seed: int):
    from pyspark.ml.classification import GBTClassifier

    chosen = lowest_keys(labelled.withColumn("_h", F.xxhash64("_url")), "_h", max_rows)
    fit = _features(chosen, shares, prior).select("_x", (F.col("_listed") == "block").cast("double").alias("_y"))
    fit = written(fit.coalesce(FIT_PARTITIONS), "url-fit")
    trees = GBTClassifier(featuresCol="_x", labelCol="_y", predictionCol="_block",
                          maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=seed, cacheNodeIds=False)
    return trees.fit(fit).setRawPredictionCol("_raw").setProbabilityCol("_p")


def held_out_report(pages: DataFrame, url_col: str = "url", rules=RULES, fold: int = 0, max_rows: int = MAX_FIT_ROWS,
                    seed: int = 11) -> dict[str, float]:
    """Rows, accuracy and log loss on the hosts of ``fold`` of a model fitted without
    them, and the loss of the plain share of blocked URLs."""
    from pyspark.ml.functions import vector_to_array

    labelled = _labelled(pages, url_col, rules)
    rest = labelled.filter(F.col("_fold") != fold)
    shares, prior = suffix_shares(rest)
    model = fit_trees(rest, shares, prior, max_rows, seed)
    unseen = _features(labelled.filter(F.col("_fold") == fold).withColumn("_fold", F.lit(ALL)), shares, prior)
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.get(vector_to_array("_p"), 1)))
    blocked = F.col("_listed") == "block"
    out = model.transform(unseen).agg(
        F.count("*").alias("rows"), F.avg(((F.col("_block") == 1) == blocked).cast("double")).alias("accuracy"),
        F.avg(-F.log(F.when(blocked, p).otherwise(1 - p))).alias("loss"),
        F.avg(-F.log(F.when(blocked, F.lit(prior)).otherwise(F.lit(1 - prior)))).alias("plain_loss"))
    return out.first().asDict()


def judge_urls(pages: DataFrame, url_col: str = "url", rules=RULES, max_rows: int = MAX_FIT_ROWS, seed: int = 11) -> DataFrame:
    """``pages`` with ``_host, _path, _rule`` and ``_verdict``."""
    pages = pages.select(*[c for c in pages.columns if not c.startswith("_")])
    urls = lexical(pages, url_col, rules)
    labelled = _labelled(pages, url_col, rules)
    kinds = [r[0] for r in labelled.select("_listed").distinct().collect()]  # block, allow
    if len(kinds) < 2:
        return urls.withColumn("_verdict", F.coalesce("_listed", F.lit(kinds[0] if kinds else "allow"))) \
            .select(*pages.columns, "_host", "_path", "_rule", "_verdict")
    shares, prior = suffix_shares(labelled)
    scored = fit_trees(labelled, shares, prior, max_rows, seed).transform(_features(urls, shares, prior))
    return scored.withColumn("_verdict", F.coalesce("_listed", F.when(F.col("_block") == 1, "block").otherwise("allow"))) \
        .select(*pages.columns, "_host", "_path", "_rule", "_verdict")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"),
                                    F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))
