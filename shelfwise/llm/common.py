"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: words of a text: maximal runs of characters other than space and \t\n\v\f\r
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_run_folder: ContextVar[str | None] = ContextVar("shelfwise_run_folder", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.  Where the session names none, a local
    session (tests) takes a temporary folder; a cluster's is refused, as its executors
    would each write to a disk of their own."""
    root = _run_folder.get() or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="shelfwise-llm-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_run(spark: SparkSession):
    """All scratch tables written inside go to one folder, which is removed at the end.
    What is still to be read must be written elsewhere before."""
    path = scratch_path(spark, "run")
    token = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(token)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        try:
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        except Py4JJavaError as refused:  # left behind; no result depends on it
            print(f"[WARN] {path} was not removed: {refused.java_exception}")


def written(df: DataFrame, label: str, narrow: bool = False) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, and computes what several later steps read only once.

    ``narrow`` is for tables of a few bytes a row: an eighth of the shuffle
    partitions (8 at least) write them, so that they don't become many tiny files.
    """
    if narrow:
        df = df.coalesce(max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8))
    return written_to(df, scratch_path(df.sparkSession, label))


def written_to(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_own_names(docs: DataFrame, step, **columns) -> DataFrame:
    """``step`` over ``docs`` with its columns renamed, so that none can clash with a
    helper column; the result has the columns of ``docs``.  ``columns`` are the
    arguments of ``step`` that name a column."""
    at = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    out = step(docs.toDF(*at.values()), **{k: at[c] for k, c in columns.items()})
    return out.select(*[F.col(x).alias(c) for c, x in at.items()])


def worker_state(name: str, make):
    """``make()`` once per Python worker process, kept between its tasks.

    Workers outlive a stage and serve the next one, so a worker holds the state of one
    operator (what stands before a colon in ``name``) at a time: caches of the stages of
    a pipeline don't add up."""
    holder = sys.modules.setdefault("_shelfwise_worker_state", types.ModuleType("_shelfwise_worker_state"))
    kept = holder.__dict__.setdefault("kept", {})
    if name not in kept:
        owner = name.split(":")[0]
        if others := [x for x in kept if x.split(":")[0] != owner]:
            drop_worker_state(*others)
        kept[name] = make()
    return kept[name]


def drop_worker_state(*names: str) -> None:
    """Free what operators keep in this Python worker: the states named, or all."""
    kept = getattr(sys.modules.get("_shelfwise_worker_state"), "kept", {})
    gone = [kept.pop(x) for x in names or list(kept) if x in kept]
    if gone:
        import pyarrow as pa

        del gone
        pa.default_memory_pool().release_unused()


def whole_groups(frames, keys: list[str]):
    """Whole groups, one at a time, of pandas batches sorted by ``keys``."""
    import pandas as pd

    held = None
    for pdf in frames:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        code = pdf[keys].to_numpy()
        first = [0, *((code[1:] != code[:-1]).any(1).nonzero()[0] + 1).tolist()]
        for begin, end in zip(first, first[1:]):
            yield pdf.iloc[begin:end]
        held = pdf.iloc[first[-1]:]
    if held is not None and len(held):
        yield held


def lowest_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows of ``df``, one for each ``key`` (a 64-bit hash), those of
    smallest key.

    Rows above a threshold that leaves about ``2 * n`` of them go first, so what a sort
    and a limit bring to one task is a few times ``n`` rows however large the table.
    (Where most rows repeat a key, fewer than ``n`` may be left.)"""
    total = df.count()
    if total > 4 * n:
        df = df.filter(F.col(key) < int(2 * n / total * 2.0 ** 64) - (1 << 63))
    return df.dropDuplicates([key]).orderBy(key).limit(n)


def words_of(text: Column) -> Column:
    """Words of a text in order (NULL and blank texts: empty array)."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{GAP}|{GAP}$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """Smallest reachable id of every node of an undirected graph.

    ``edges`` has long columns ``u`` and ``v``.  Returns ``id, component`` for
    the nodes that have an edge to another node.

    Each round points every node at its smallest neighbour, follows that
    pointer once more, and contracts the edges to the pointed-at nodes, until
    no edge is left; every edge chain at least halves, so the number of rounds
    is logarithmic.  A node with very many edges is one row of a map-side
    combined ``min``, and one key of a join that Spark may split.
    """
    spark = edges.sparkSession
    both = edges.filter("u <> v")
    live = written(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{label}-edges", narrow=True)
    labels = None
    while not live.isEmpty():
        directed = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = directed.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("p"))
        nearest = written(nearest, f"{label}-nearest", narrow=True)
        up = nearest.select(F.col("id").alias("p"), F.col("p").alias("pp"))
        jump = written(nearest.join(up, "p").select("id", F.col("pp").alias("to")), f"{label}-jump", narrow=True)
        if labels is None:
            labels = jump.select("id", F.col("to").alias("component"))
        else:
            moved = jump.select(F.col("id").alias("component"), "to")
            labels = written(
                labels.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component")),
                f"{label}-labels", narrow=True)
        ju = jump.select(F.col("id").alias("u"), F.col("to").alias("tu"))
        jv = jump.select(F.col("id").alias("v"), F.col("to").alias("tv"))
        live = written(
            live.join(ju, "u").join(jv, "v").filter("tu <> tv")
            .select(F.greatest("tu", "tv").alias("u"), F.least("tu", "tv").alias("v")).distinct(),
            f"{label}-edges", narrow=True)
    if labels is None:
        return spark.createDataFrame([], "id long, component long")
    return labels
