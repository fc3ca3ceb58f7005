"""Mixing sources to target weights by iterative proportional fitting.

Tokens (words) are summed per cell of source, language and topic.  The cells'
weights, which add up to the tokens wanted (the budget), are raked: each sweep scales them
to the source shares wanted, then to the language shares, then to the topic shares.  No
cell can give more tokens than it has, so raking is bounded: the cells at their bound are
fixed and the others scaled to what the marginal still lacks, again in every sweep, until
no marginal is off by more than ``TOLERANCE``.  A cell's ratio of raked weight to tokens
is the probability of its documents, and the marginals of the probabilities are the targets.

A share that the corpus cannot give (more tokens wanted of a value than it has) is cut to
what it has, and the other values of that dimension take the rest; ``mix_report`` lists
for each value the share wanted, the share aimed at and the share reached.  Documents are
drawn by a hash of their id, so a draw repeats exactly.

Everything that grows with the corpus stays distributed: cells and marginals are
tables, and above ``TASK_CELLS`` cells each raking step is a map-side combined sum and a
join; a smaller table is raked in one task.

The topic of a document is the nearest of ``TOPICS`` centres in a space of hashed word
frequencies (words of ``TOPIC_WORD_CHARS`` characters or more, weighted by their rarity).
The centres are found by spherical k-means over every different text of the corpus: the
words of a text are counted once, and each round is a pass over the counts whose sums
Spark adds up, so that the driver sees the centres alone.  Sums are whole numbers: the
centres depend on the rows, not on how they are dealt out.  Documents without such a word
have topic ``TOPICS``.

Defined cases: NULL source or language is a value of its own; NULL, empty and
blank texts hold no tokens, and are kept with the probability of the budget; texts of
any length are read whole; a document as near to two centres takes the first; repeated
rows share one draw; targets for values that do not occur are dropped
and the others scaled up; an empty table gives no rows; other columns pass
through.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import in_own_names, read_table, worker_state, written

TOPICS = 8
TOPIC_WORD_CHARS = 4
TOPIC_CELLS, TOPIC_ROUNDS = 1_024, 12
#: texts are taken so many at a time in a task
TOPIC_BLOCK = 1_000
#: entries of unit vectors are summed as whole multiples of 1 / TOPIC_UNIT
TOPIC_UNIT = 1 << 30
FLATTEN = 0.7
BUDGET = 0.8
SWEEPS = 60
TOLERANCE = 5e-4
#: rows of the table of cells that one task takes
TASK_CELLS = 50_000
DIMENSIONS = ("source", "lang", "topic")
SEED = 20240


class _WordCells(dict):
    """The hashed cell of a word, or -1 for a word that tells no topic."""

    def __missing__(self, word):
        if len(self) >= 200_000:
            self.clear()
        plain = word.strip(".,;:!?\"'()-").lower()
        self[word] = cell = zlib.crc32(plain.encode("utf-8", "surrogatepass")) % TOPIC_CELLS if len(plain) >= TOPIC_WORD_CHARS and plain.isalpha() else -1
        return cell


def topic_counts(text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words of a whole text, the cells it has and its counts in them."""
    words = (text or "").split()
    cells = np.fromiter(map(worker_state("topic_cells", _WordCells).__getitem__, words), "i8", len(words))
    counts = np.bincount(cells[cells >= 0], minlength=TOPIC_CELLS)
    found = np.flatnonzero(counts)
    return len(words), found, counts[found]


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_tokens`` and, as bytes, ``_word_cells`` and ``_word_counts``."""
    @F.pandas_udf("tokens long, cells binary, counts binary")
    def count(texts):
        import pandas as pd

        found = [topic_counts(text) for text in texts]
        return pd.DataFrame({"tokens": [n for n, _, _ in found], "cells": [c.astype("<u2").tobytes() for _, c, _ in found],
                             "counts": [n.astype("<u4").tobytes() for _, _, n in found]})

    seen = docs.withColumn("_seen", count(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return seen.withColumns({"_tokens": F.col("_seen.tokens"), "_word_cells": F.col("_seen.cells"),
                             "_word_counts": F.col("_seen.counts")}).drop("_seen")


def _numbers(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in an Arrow array of bytes, one value after the other, and how many each has."""
    width = np.dtype(kind).itemsize
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, "<i4")[column.offset:column.offset + len(column) + 1].astype("i8") // width
    return np.frombuffer(data, kind, len(data) // width if data else 0)[ends[0]:ends[-1]], np.diff(ends)


class _Block:
    """Some texts that have a cell: where each starts in ``cells`` and ``roots`` (of the counts)."""

    def __init__(self, cells, counts):
        """``cells`` and ``counts`` are Arrow arrays of bytes."""
        self.cells, self.sizes = _numbers(cells, "<u2")
        self.cells = self.cells.astype("i8")
        self.roots = np.sqrt(_numbers(counts, "<u4")[0].astype("f8"))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def units(self, weight: np.ndarray) -> np.ndarray:
        """Entries of the texts' weighted unit vectors."""
        x = self.roots * weight.take(self.cells)
        return x / np.repeat(np.maximum(np.sqrt(np.add.reduceat(x * x, self.starts)), 1e-12), self.sizes)

    def near(self, x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """``[texts, centres]``: products with ``centres`` (``[TOPIC_CELLS, centres]``), text by text."""
        return np.stack([np.add.reduceat(x * c.take(self.cells), self.starts) for c in np.ascontiguousarray(centres.T)], 1)


def _blocks(batches):
    """Arrow batches of ``key, cells, counts`` as pairs of keys and block."""
    for batch in batches:
        for at in range(0, batch.num_rows, TOPIC_BLOCK):
            key, cells, counts = batch.slice(at, TOPIC_BLOCK).columns
            yield key.to_numpy(), _Block(cells, counts)


def _summed(texts: DataFrame, size: int, add) -> np.ndarray:
    """``size`` whole numbers: the sums of ``add(block)`` over all texts."""
    def run(batches):
        import pyarrow as pa

        total = np.zeros(size, "i8")
        for _, block in _blocks(batches):
            total += add(block)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["at", "n"])

    found = texts.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size, "i8")
    total[found["at"].to_numpy()] = found["n"].to_numpy()
    return total


def _farthest(texts: DataFrame, weight: np.ndarray, centres: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
    """The text whose product with the nearest of ``centres`` is largest (``sign`` 1) or
    smallest (-1), the one of smallest key among equals: that product and its unit vector."""
    def run(batches):
        import pyarrow as pa

        best = None
        for key, block in _blocks(batches):
            x = block.units(weight)
            score = -sign * block.near(x, centres).max(1)
            i = np.lexsort((key, score))[0]
            if best is None or (score[i], key[i]) < best[:2]:
                mine = slice(block.starts[i], block.starts[i] + block.sizes[i])
                best = float(score[i]), int(key[i]), block.cells[mine].astype("<u2").tobytes(), x[mine].tobytes()
        if best:
            yield pa.RecordBatch.from_pylist([dict(zip(("score", "key", "cells", "units"), best))])

    found = texts.mapInArrow(run, "score double, key long, cells binary, units binary").orderBy("score", "key").limit(1).first()
    unit = np.zeros(TOPIC_CELLS)
    unit[np.frombuffer(found.cells, "<u2")] = np.frombuffer(found.units, "f8")
    return -sign * found.score, unit


def topic_centres(texts: DataFrame, rounds: int = TOPIC_ROUNDS) -> np.ndarray:
    """``[TOPIC_CELLS, at most TOPICS]``: weighted unit centres of all rows of ``texts``
    (``key, cells, counts``, every key once, none without a cell).  ``texts`` is read in
    every pass, so it should be a written table.  The first centres are chosen far apart."""
    def texts_in(block):
        return np.append(np.bincount(block.cells, minlength=TOPIC_CELLS), len(block.sizes))

    *having, n = _summed(texts, TOPIC_CELLS + 1, texts_in)
    if not n:
        return np.zeros((TOPIC_CELLS, 0))
    weight = np.log((1 + n) / (1 + np.array(having)))

    def sums_of(centres):
        def add(block):
            x = block.units(weight)
            at = np.repeat(np.argmax(block.near(x, centres), 1), block.sizes)
            return np.bincount(at * TOPIC_CELLS + block.cells, np.rint(x * TOPIC_UNIT), centres.size).astype("i8")
        return _summed(texts, centres.size, add).reshape(-1, TOPIC_CELLS)

    mean = sums_of(np.zeros((TOPIC_CELLS, 1)))[0] / (TOPIC_UNIT * float(n))
    centres = _farthest(texts, weight, mean[:, None], 1.0)[1][:, None]
    while centres.shape[1] < TOPICS:
        near, unit = _farthest(texts, weight, centres, -1.0)
        if near >= 1 - 1e-9:
            break
        centres = np.column_stack([centres, unit])
    last = None
    for _ in range(rounds):
        sums = sums_of(centres)
        if last is not None and (sums == last).all():
            break
        last = sums
        for k in range(centres.shape[1]):
            if sums[k].any():
                centres[:, k] = sums[k] / np.linalg.norm(sums[k].astype("f8"))
    return centres * weight[:, None]


def _different(counted: DataFrame, text_col: str) -> DataFrame:
    """``key, cells, counts`` of the different texts of ``word_counts`` that have a cell."""
    texts = counted.filter(F.length("_word_cells") > 0).select(
        F.xxhash64(F.col(text_col).cast("string")).alias("key"), F.col("_word_cells").alias("cells"), F.col("_word_counts").alias("counts"))
    return written(texts.dropDuplicates(["key"]), "mix-texts", narrow=True)  # of which every pass is a job


def fit_topics(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Centres fitted on all different texts."""
    return topic_centres(_different(word_counts(docs.select(text_col), text_col), text_col))


def _in_cells(counted: DataFrame, centres: np.ndarray, source_col: str, lang_col: str) -> DataFrame:
    """``word_counts`` with the cell columns in place of the counts."""
    @F.pandas_udf("int")
    def nearest(cells, counts):
        import pandas as pd
        import pyarrow as pa

        topic = np.full(len(cells), TOPICS, "i4")
        some = np.flatnonzero(cells.str.len().to_numpy() > 0) if centres.size else np.zeros(0, "i8")
        for at in range(0, len(some), TOPIC_BLOCK):
            mine = some[at:at + TOPIC_BLOCK]
            block = _Block(pa.array(cells.iloc[mine], pa.binary()), pa.array(counts.iloc[mine], pa.binary()))
            topic[mine] = np.argmax(block.near(block.roots, centres), 1)
        return pd.Series(topic)

    def value(name):  # NULL apart from every string
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))

    return counted.withColumns({"_source": value(source_col), "_lang": value(lang_col), "_topic": nearest("_word_cells", "_word_counts")}) \
        .drop("_word_cells", "_word_counts")


def describe(docs: DataFrame, centres: np.ndarray, text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``_tokens`` and the cell columns ``_source, _lang, _topic``."""
    return _in_cells(word_counts(docs, text_col), centres, source_col, lang_col)


def _described(docs: DataFrame, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """``describe`` with the topics of ``docs``; texts go through Python once."""
    counted = written(word_counts(docs, text_col), "mix-counted")
    return _in_cells(counted, topic_centres(_different(counted, text_col)), source_col, lang_col)


def _targets(cells: DataFrame, dim: str, wanted: DataFrame | None, flatten: float) -> DataFrame:
    """``_dim, target``: shares of the values that occur; by default the token
    shares to the power ``flatten``."""
    key = f"_{dim}"
    sums = cells.groupBy(key).agg(F.sum("tokens").cast("double").alias("t"))
    if wanted is not None:
        prefix = F.lit("=") if dim != "topic" else F.lit("")
        named = wanted.select(F.coalesce(F.concat(prefix, F.col(dim).cast("string")), F.lit("")).alias("_name"), "share")
        raw = sums.join(named, F.col(key).cast("string") == F.col("_name"), "left").select(key, F.coalesce("share", F.lit(0.0)).alias("raw"))
    else:
        raw = sums.select(key, F.pow("t", F.lit(flatten)).alias("raw"))
    total = raw.agg(F.sum("raw")).first()[0] or 1.0
    return written(raw.select(key, (F.col("raw") / F.lit(total)).alias("target")), f"mix-target-{dim}")


def reachable(targets: DataFrame, cells: DataFrame, dim: str, goal: float) -> DataFrame:
    """``targets`` with ``wanted`` (the share asked for), and ``target`` cut to the share of
    ``goal`` that the value's cells hold, the other values taking the rest in proportion."""
    key = f"_{dim}"
    have = cells.groupBy(key).agg(F.sum("cap").alias("have"))
    both = written(targets.join(have, key).withColumnRenamed("target", "wanted"), f"mix-reach-{dim}", narrow=True)
    factor = 1.0
    for _ in range(100):  # values at their limit stay there as the factor grows
        full = F.col("wanted") * F.lit(factor) >= F.col("have")
        held, free = both.agg(F.sum(F.when(full, F.col("have"))), F.sum(F.when(~full, F.col("wanted")))).first()
        grown = (1 - (held or 0.0)) / free if free else factor
        if grown <= factor * (1 + 1e-12):
            break
        factor = grown
    return both.select(key, "wanted", F.least(F.col("have"), F.col("wanted") * F.lit(factor)).alias("target"))


def _raked_in_a_task(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int, tolerance: float) -> DataFrame:
    """The sweeps of ``rake`` over at most ``TASK_CELLS`` cells, which one task takes in any
    case: as jobs of their own, hundreds of plans would fill the driver's memory."""
    for dim in DIMENSIONS:
        cells = cells.join(targets[dim].select(f"_{dim}", F.col("target").alias(f"_target_{dim}")), f"_{dim}")
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("_source", "_lang", "_topic", "tokens", "weight"))

    def run(frames):
        import pandas as pd

        pdf = pd.concat(list(frames) or [pd.DataFrame(columns=list(kinds))], ignore_index=True)
        cap, weight = pdf["cap"].to_numpy("f8"), pdf["weight"].to_numpy("f8")
        sides = []
        for dim in DIMENSIONS:
            code, values = pd.factorize(pdf[f"_{dim}"])
            target = np.zeros(len(values))
            target[code] = pdf[f"_target_{dim}"].to_numpy("f8")
            sides.append((code, target))
        for _ in range(sweeps if len(pdf) else 0):
            moved = 0.0
            for code, target in sides:
                full = weight >= cap
                fixed = np.bincount(code, np.where(full, cap, 0.0), len(target))
                free = np.bincount(code, np.where(full, 0.0, weight), len(target))
                need, both = target - fixed, fixed + free
                off = np.abs(both - target) / np.maximum(target, 1e-12)
                moved = max(moved, off[(both != 0) & ((free > 0) | (need <= 0))].max(initial=0.0))
                whole = np.divide(target, both, out=np.ones_like(both), where=both > 0)[code]
                grown = weight * need[code] / np.where(free > 0, free, 1.0)[code]
                cut = np.where(whole < 1, np.minimum(weight, cap) * whole, weight)
                weight = np.where(((need <= 0) | (free <= 0))[code], cut, grown)
            if moved <= tolerance:
                break
        yield pdf[["_source", "_lang", "_topic", "tokens"]].assign(weight=np.minimum(weight, cap))

    ordered = cells.repartition(1).sortWithinPartitions("_source", "_lang", "_topic")
    return written(ordered.mapInPandas(run, schema), "mix-raked")


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (``_source, _lang, _topic, tokens`` and optionally ``cap``, the largest
    weight of a cell) with ``weight`` raked to the marginals ``targets`` (``_dim, target``).

    ``weight`` starts as the token share.  A step solves, for one dimension, what factor the
    cells below their cap need for the marginal, with the others at their cap; where the
    capped cells alone hold more than the target, all are scaled down from their caps."""
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    if "cap" not in cells.columns:
        cells = cells.withColumn("cap", F.lit(float("inf")))
    tasks = max(1, -(-cells.count() // TASK_CELLS))
    started = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    if tasks == 1:
        return _raked_in_a_task(started, targets, sweeps, tolerance)
    now = written(started.coalesce(tasks), "mix-cells")
    kept = ["_source", "_lang", "_topic", "tokens", "cap", "weight"]
    full, bounded = F.col("weight") >= F.col("cap"), F.least("weight", "cap")
    for _ in range(sweeps):
        moved = F.lit(0.0)
        for dim in DIMENSIONS:
            key = f"_{dim}"
            sums = now.groupBy(key).agg(F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)).alias("_fixed"),
                                        F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("_free"))
            need = F.col("target") - F.col("_fixed")
            down = (need <= 0) | (F.col("_free") <= 0)
            now = now.join(sums.join(targets[dim].select(key, "target"), key), key)
            off = F.abs(F.col("_fixed") + F.col("_free") - F.col("target")) / F.greatest("target", F.lit(1e-12))
            off = F.when((F.col("_fixed") + F.col("_free") == 0) | ((F.col("_free") <= 0) & (need > 0)), 0.0).otherwise(off)
            whole = F.when(F.col("_fixed") + F.col("_free") > 0, F.col("target") / (F.col("_fixed") + F.col("_free"))).otherwise(1.0)
            scaled = F.when(~down, F.col("weight") * need / F.col("_free")) \
                .when(whole < 1, bounded * whole).otherwise(F.col("weight"))
            now = now.withColumns({f"_moved_{dim}": off, "weight": scaled}).drop("_fixed", "_free", "target")
            moved = F.greatest(moved, F.col(f"_moved_{dim}"))
        now = written(now.withColumn("_moved", moved).select(*kept, "_moved").coalesce(tasks), "mix-sweep")
        if (now.agg(F.max("_moved")).first()[0] or 0.0) <= tolerance:
            break
    return now.select("_source", "_lang", "_topic", "tokens", bounded.alias("weight"))


def cell_chances(cells: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET,
                 flatten: float = FLATTEN) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``cells`` (``_source, _lang, _topic, tokens``) with ``probability``, and for each
    dimension ``_dim, wanted, target``."""
    full = cells.filter("tokens > 0")
    wanted = {d: _targets(full, d, (targets or {}).get(d), flatten) for d in DIMENSIONS}
    for d in DIMENSIONS:  # cells of a value that is not wanted give nothing
        full = full.join(wanted[d].filter("target > 0").select(f"_{d}"), f"_{d}", "left_semi")
    total, possible = cells.agg(F.sum("tokens")).first()[0] or 0, full.agg(F.sum("tokens")).first()[0] or 0
    goal = max(1.0, min(budget * total, float(possible)))
    capped = written(full.withColumn("cap", F.col("tokens") / F.lit(goal)), "mix-capped", narrow=True)
    aims = {d: written(reachable(wanted[d].filter("target > 0"), capped, d, goal), f"mix-aim-{d}", narrow=True) for d in DIMENSIONS}
    raked = rake(capped, aims).select("_source", "_lang", "_topic", (F.col("weight") * F.lit(goal) / F.col("tokens")).alias("probability"))
    chance = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.coalesce("probability", F.lit(0.0)))).otherwise(F.lit(budget))
    return cells.join(raked, ["_source", "_lang", "_topic"], "left").withColumn("probability", chance), aims


def mix_report(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, flatten: float = FLATTEN,
               text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``dimension, value, wanted, target, reached, reachable``: the share of the expected
    tokens that was asked for, the one aimed at (cut to what the value has), and the one
    that the probabilities give; ``reachable`` is false where the first could not be met."""
    described = _described(docs, text_col, source_col, lang_col)
    cells = written(described.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens")), "mix-tokens", narrow=True)
    chances, aims = cell_chances(cells, targets, budget, flatten)
    mass = written(chances.withColumn("mass", F.col("tokens") * F.col("probability")), "mix-mass", narrow=True)
    total = mass.agg(F.sum("mass")).first()[0] or 1.0
    out = None
    for d in DIMENSIONS:
        name = F.col(f"_{d}").cast("string")
        value = name if d == "topic" else F.when(name != "", F.substring(name, 2, 1 << 30))
        one = aims[d].join(mass.groupBy(f"_{d}").agg((F.sum("mass") / F.lit(total)).alias("reached")), f"_{d}").select(
            F.lit(d).alias("dimension"), value.alias("value"), "wanted", "target", "reached",
            (F.abs(F.col("target") - F.col("wanted")) <= 1e-9).alias("reachable"))
        out = one if out is None else out.unionByName(one)
    return out


def uniform(id_col: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the id alone."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, flatten: float = FLATTEN,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``_tokens``, the cell columns, ``_probability`` and
    ``_sampled`` (columns of these names are replaced).  ``targets`` maps a dimension to a frame of its values and
    their ``share``."""
    described = _described(docs, text_col, source_col, lang_col)
    cells = written(described.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens")), "mix-tokens", narrow=True)
    chances, _ = cell_chances(cells, targets, budget, flatten)
    chances = written(chances.select("_source", "_lang", "_topic", F.col("probability").alias("_probability")), "mix-chances", narrow=True)
    out = described.join(chances, ["_source", "_lang", "_topic"], "left")
    chance = F.when(F.col("_tokens") == 0, F.lit(budget)).otherwise(F.col("_probability"))
    # without an id, the text draws
    drawn = F.when(F.col(id_col).isNull(), uniform(F.xxhash64(F.col(text_col)))).otherwise(uniform(F.col(id_col)))
    return out.withColumn("_probability", chance).withColumn("_sampled", drawn < F.col("_probability"))


def sample_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               lang_col: str = "lang", **options) -> DataFrame:
    """The sampled rows of ``docs``, with its columns."""
    return in_own_names(docs, lambda inner, **names: mixed(inner, **names, **options).filter("_sampled"),
                        id_col=id_col, text_col=text_col, source_col=source_col, lang_col=lang_col)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixed(docs).select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
                              F.col("_probability").alias("probability"), F.col("_sampled").alias("sampled"))
