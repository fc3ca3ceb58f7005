"""Quality classifier: a generalised additive model with pairwise interactions.

A document becomes a few numbers computed from its whole text (``FEATURES``).
Each is binned at quantiles.  Cyclic boosting visits the features in turn and
fits a tree of at most three leaves to the current log-loss gradients of that
one feature's bins; the trees of a feature add up to one lookup table.  The
pairs that still explain most of the gradient then get two-dimensional tables in
the same way.  Scoring looks up one number per feature and pair and adds them.

Fitting happens on at most ``MAX_FIT_ROWS`` labelled rows (those with the
smallest hash of the id, so the choice is the same in every run and order);
scoring covers every row.

Defined cases: NULL and blank texts are scored like any other (their features
are zero); without labels, or with labels of one kind, the score is the share of
label 1 (a half without any); a document labelled more than once counts with its
smallest label; NULL labels are ignored; texts of any length are read whole; a score
of exactly a half is label 1; repeated rows get the same score; an empty table gives no
row; other columns pass through, but ``score_quality`` replaces one named like its score.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import drop_worker_state, in_own_names, lowest_keys, read_table, written

FEATURES = ("log_words", "word_length", "symbol_share", "mark_share", "upper_share", "digit_share", "exclaim_share",
            "pipe_share", "distinct_words", "top_word_share", "repeat_windows", "repeat_lines", "line_words",
            "ended_lines", "letterless_words", "wide_share", "char_entropy")
MAX_FIT_ROWS = 20_000
FIT_PARTITIONS = 16  # of the bounded sample
MAX_BINS = 32
ROUNDS, PAIR_ROUNDS, PAIRS = 80, 30, 6
RATE, SMOOTH = 0.15, 5.0

_SYMBOLS = np.frombuffer(b"#*$%&|<>", "u1")
_MARKS = np.frombuffer(b".,;:'\"()-?", "u1")


def features_of(text: str | None) -> np.ndarray:
    """``FEATURES`` of one whole text."""
    out = np.zeros(len(FEATURES))
    words = (text or "").split()
    if not words:
        return out
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), "u1")
    count = np.bincount(raw, minlength=256)
    chars = max(1, int(count.sum() - count[32] - count[9:14].sum()))
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    hashes = np.fromiter(map(hash, words), "i8", len(words)).view("u8")
    uniques, times = np.unique(hashes, return_counts=True)
    repeat = 0.0
    if len(words) >= 5:
        w = hashes[:-4].copy()
        for k in range(1, 5):
            w = w * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - 4 + k]
        _, n = np.unique(w, return_counts=True)
        repeat = float(n[n > 1].sum()) / len(w)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    share = count[count > 0] / len(raw)
    out[:] = (
        np.log1p(len(words)), chars / len(words), count[_SYMBOLS].sum() / chars, count[_MARKS].sum() / chars,
        upper / max(1, upper + lower), count[48:58].sum() / chars, count[33] / chars, count[124] / chars,
        len(uniques) / len(words), times.max() / len(words), repeat, 1 - len(set(lines)) / len(lines),
        np.log1p(len(words) / len(lines)), sum(x.rstrip()[-1:] in ".!?" for x in lines) / len(lines),
        sum(not any(c.isalpha() for c in x[:12]) for x in words) / len(words) if count[48:58].sum() + count[_SYMBOLS].sum() else 0.0,
        count[128:].sum() / len(raw), float(-(share * np.log2(share)).sum()),
    )
    return out


@dataclass
class Gam:
    """Lookup tables: ``score = sigmoid(base + sum of the tables' entries)``."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], 1) \
            if len(self.cuts) else np.zeros((len(x), 0), "i8")

    def margin(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for j, table in enumerate(self.tables):
            total += table[bins[:, j]]
        for i, j, table in self.pairs:
            total += table[bins[:, i], bins[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(self.bins(x)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _gain(g, h):
    return g * g / (h + SMOOTH)


def _small_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values per bin of the best tree with up to three leaves over one
    feature's ordered bins (gradient and curvature sums ``g``, ``h``)."""
    leaves = [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None)
        for lo, hi in leaves:
            cg, ch = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            if not len(cg):
                continue
            tg, th = g[lo:hi].sum(), h[lo:hi].sum()
            gains = _gain(cg, ch) + _gain(tg - cg, th - ch) - _gain(tg, th)
            k = int(gains.argmax())
            if gains[k] > best[0]:
                best = (float(gains[k]), (lo, lo + k + 1, hi))
        if best[1] is None:
            break
        lo, mid, hi = best[1]
        leaves.remove((lo, hi))
        leaves += [(lo, mid), (mid, hi)]
    out = np.zeros(len(g))
    for lo, hi in leaves:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + SMOOTH)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree that cuts each of two features once: gain and values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    parts = [(a, b), (cg[:-1, -1:] - a, ch[:-1, -1:] - b), (cg[-1:, :-1] - a, ch[-1:, :-1] - b)]
    parts.append((cg[-1, -1] - sum(p[0] for p in parts), ch[-1, -1] - sum(p[1] for p in parts)))
    gains = sum(_gain(*p) for p in parts) - _gain(cg[-1, -1], ch[-1, -1])
    r, c = np.unravel_index(int(gains.argmax()), gains.shape)
    out = np.zeros(g.shape)
    for k, (rows, cols) in enumerate(((slice(None, r + 1), slice(None, c + 1)), (slice(None, r + 1), slice(c + 1, None)),
                                      (slice(r + 1, None), slice(None, c + 1)), (slice(r + 1, None), slice(c + 1, None)))):
        out[rows, cols] = parts[k][0][r, c] / (parts[k][1][r, c] + SMOOTH)
    return float(gains[r, c]), out


def fit_gam(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit by cyclic boosting; every fifth row decides when to stop."""
    share = y.mean() if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Gam(float(np.log((share + 1e-3) / (1 - share + 1e-3))), [], [])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, MAX_BINS + 1)[1:-1])) for j in range(x.shape[1])]
    model = Gam(float(np.log(share / (1 - share))), cuts, [np.zeros(len(c) + 1) for c in cuts])
    bins = model.bins(x)
    check = np.arange(len(y)) % 5 == 4
    fit = ~check
    margin = model.margin(bins)

    def loss():
        z = margin[check]
        return float(np.mean(np.logaddexp(0, z) - y[check] * z)) if check.any() else 0.0

    def boost(rounds, step):
        """Steps until the held-back rows stop gaining; returns to their best."""
        best, kept = loss(), step(None)
        for _ in range(rounds):
            step(True)
            now = loss()
            if now < best - 1e-6:
                best, kept = now, step(None)
        return kept

    def main_step(go):
        if go is None:
            return [t.copy() for t in model.tables]
        for j, table in enumerate(model.tables):
            p = _sigmoid(margin[fit])
            b = bins[fit, j]
            move = RATE * _small_tree(np.bincount(b, y[fit] - p, len(table)), np.bincount(b, p * (1 - p), len(table)))
            table += move
            margin[:] += move[bins[:, j]]

    model.tables = boost(ROUNDS, main_step)
    margin = model.margin(bins)

    def sums(i, j):
        p = _sigmoid(margin[fit])
        shape = (len(cuts[i]) + 1, len(cuts[j]) + 1)
        at = bins[fit, i] * shape[1] + bins[fit, j]
        size = shape[0] * shape[1]
        return (np.bincount(at, y[fit] - p, size).reshape(shape), np.bincount(at, p * (1 - p), size).reshape(shape))

    ranked = sorted(((-_quadrants(*sums(i, j))[0], i, j) for i in range(len(cuts)) for j in range(i)))[:PAIRS]
    model.pairs = [(i, j, np.zeros((len(cuts[i]) + 1, len(cuts[j]) + 1))) for _, i, j in ranked]

    def pair_step(go):
        if go is None:
            return [(i, j, t.copy()) for i, j, t in model.pairs]
        for i, j, table in model.pairs:
            move = RATE * _quadrants(*sums(i, j))[1]
            table += move
            margin[:] += move[bins[:, i], bins[:, j]]

    model.pairs = boost(PAIR_ROUNDS, pair_step)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may see: ``crc32(id as text) mod 3 = 1``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, x`` with ``x`` the features of each row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def compute(batches):
        drop_worker_state()
        for batch in batches:
            x = [features_of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, schema.field(1).type)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(compute, "doc_id long, x array<double>")


def fit_quality_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      label_col: str = "quality", max_rows: int = MAX_FIT_ROWS) -> Gam:
    """Fit on labelled rows outside the held-out third: at most ``max_rows`` ids, those of
    smallest hash (of an id with several texts, its smallest text).  Only their texts are
    read for features."""
    marks = labels.filter(F.col(label_col).isNotNull() & ~held_out(F.col(id_col))) \
        .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).cast("double").alias("y"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marks = written(marks.join(texts.select("doc_id"), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id")), "quality-marks", narrow=True)
    ids = written(lowest_keys(marks, "h", max_rows), "quality-ids", narrow=True)
    rows = texts.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    x = feature_table(rows.repartition(FIT_PARTITIONS), "doc_id", "text")
    chosen = x.join(ids, "doc_id").orderBy("h").select("x", "y").collect()  # at most max_rows short rows
    return fit_gam(np.asarray([r.x for r in chosen]).reshape(-1, len(FEATURES)), np.asarray([r.y for r in chosen]))


def score_quality(docs: DataFrame, model: Gam, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of every row's whole text."""
    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        drop_worker_state()
        x = [features_of(t) for t in texts]
        return pd.Series(model.score(np.asarray(x).reshape(-1, len(FEATURES))))

    return docs.withColumn(score_col, score(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def keep_quality(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose predicted label is 1."""
    model = fit_quality_model(docs, labels, text_col=text_col, **options)
    return in_own_names(docs, lambda inner, text_col: score_quality(inner, model, text_col).filter("score >= 0.5"), text_col=text_col)


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality_model(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
