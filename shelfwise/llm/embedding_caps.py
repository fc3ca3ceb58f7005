"""Near-duplicate embeddings by spherical-cap filters.

Filter directions form a product code: after a fixed random rotation a vector is cut
into two parts, each with its own ``words`` random unit codewords, and every pair of
codewords is a direction (none is stored).  A vector is list-decoded to *all* directions
whose inner product reaches the cap threshold: only words that can reach it with the
best word of the other part are tried.  A vector that reaches fewer than ``LEAST``
directions takes its ``LEAST`` best.  Vectors of one label that share a direction are
compared; a pair's links are counted only in the first direction the two share.

*The code is sized to the data.*  Of n different vectors a direction should hold
``PER_DIRECTION`` and a vector should reach about ``LIST`` directions, whatever n is: the
cap is the one that holds a share ``p = PER_DIRECTION / n`` of the sphere (at most
``LARGEST_CAP``), and ``words ** 2 = list / p``.  So the work a vector grows with n only by
its ``2 * words`` inner products, and the pairs compared grow in proportion to n.  Smaller
caps need longer lists for the same recall, so beyond a million vectors the list grows by
a third with each power of ten.  Recall at the threshold is 0.99 or more (tested at 1e3 to 1e6).

A direction that very many vectors share is cut into blocks of about ``BLOCK``
vectors, and each pair of blocks is a unit of work, so no group is collected whole
and no pair is skipped.  Units return counts per vector and a spanning set of
links, never the pairs.

Equal vectors of one label are one node with a count.  Defined cases: a vector
that is NULL, zero, empty or has a NULL or non-finite component, or whose label is
NULL, links with nothing (0 links, its own component); vectors of different length
are not compared; in one or two dimensions there are a few directions and all pairs are
compared; repeated rows count as vectors of their own; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import connected_components, read_table, whole_groups, worker_state, written

LIST, LEAST = 32, 24
PER_DIRECTION, LARGEST_CAP = 16, 0.01
BLOCK = 512
COSINE = 0.93


def cap_threshold(share: float, dim: int) -> float:
    """The cosine that a share of the unit sphere's points exceeds with a direction."""
    if dim < 3:
        return float(np.cos(np.pi * share))
    cosine = np.linspace(0, 1, 100_001)
    density = (1 - cosine * cosine) ** ((dim - 3) / 2)
    beyond = np.append(np.cumsum(((density[1:] + density[:-1]) / 2)[::-1])[::-1], 0.0)
    return float(np.interp(-share, -beyond / beyond[0] / 2, cosine))


def code_size(n: int) -> tuple[int, float]:
    """Codewords a part, and the share of the sphere in a cap, for ``n`` vectors."""
    share = min(LARGEST_CAP, PER_DIRECTION / max(n, 1))
    wanted = LIST * (1 + max(0.0, np.log10(max(n, 1) / 1e6)) / 3)
    return int(np.ceil(np.sqrt(wanted / share))), share


def codebook(dim: int, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation and the different codewords of each part, for one dimension."""
    rng = np.random.default_rng(1_000_003 + dim)
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    parts = []
    for part in np.array_split(np.arange(dim), 2):
        w = rng.standard_normal((words, len(part)))
        parts.append(np.unique(w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12), axis=0))
    return rotation, parts


def decode(unit: np.ndarray, n: int) -> list[np.ndarray]:
    """All directions of the code for ``n`` vectors that each unit vector reaches, in
    ascending order."""
    dim = unit.shape[1]
    words, share = code_size(n)
    rotation, parts = worker_state(f"cap:codebook:{dim}:{words}", lambda: codebook(dim, words))
    need = worker_state(f"cap:threshold:{dim}:{share}", lambda: cap_threshold(share, dim)) * np.sqrt(2)  # directions have this length
    turned = unit @ rotation
    scores = [turned[:, part] @ w.T for part, w in zip(np.array_split(np.arange(dim), 2), parts)]
    lists = []
    for a, b in zip(*scores):
        i, j = np.flatnonzero(a + b.max() >= need), np.flatnonzero(b + a.max() >= need)
        row, col = np.nonzero(a[i][:, None] + b[j] >= need)
        codes = i[row] * words + j[col]
        if len(codes) < LEAST:  # the best sums are of the best words
            i, j = np.argsort(-a, kind="stable")[:LEAST], np.argsort(-b, kind="stable")[:LEAST]
            best = np.argsort(-(a[i][:, None] + b[j]).ravel(), kind="stable")[:LEAST]
            codes = (i[:, None] * words + j).ravel()[best]
        lists.append(np.sort(codes))
    return lists


def _unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype("f8")
    x /= np.abs(x).max(1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _filtered(nodes: DataFrame, kind: str, n: int) -> DataFrame:
    """``key, node, copies, direction, directions, vec``: a row for each direction a
    node reaches; ``vec`` holds the components as given, in the numpy type ``kind``."""
    code = "<i4" if code_size(n)[0] ** 2 < 1 << 31 else "<i8"
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("copies", pa.int64()), ("direction", pa.int64()),
                        ("directions", pa.binary()), ("vec", pa.binary())])

    def deal(batches):
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pydict()
                by_dim = {}
                for i, v in enumerate(rows["embedding"]):
                    by_dim.setdefault(len(v), []).append(i)
                for dim, picks in by_dim.items():
                    x = np.asarray([rows["embedding"][i] for i in picks], kind)
                    out = []
                    for i, v, codes in zip(picks, x, decode(_unit(x), n)):
                        codes = codes.astype(code)
                        shared = codes.tobytes(), v.tobytes()
                        for c in codes.tolist():
                            key = xxhash.xxh3_64_intdigest(f"{rows['label'][i]}/{dim}/{c}") - (1 << 63)
                            out.append((key, rows["node"][i], rows["copies"][i], c, *shared))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return nodes.select("node", "label", "embedding", "copies").mapInArrow(
        deal, "key long, node long, copies long, direction long, directions binary, vec binary")


def _first_shared(directions: list[np.ndarray], here: int) -> np.ndarray:
    """``[i, j]``: no direction before ``here`` is common to i and j."""
    before = [d[:np.searchsorted(d, here)] for d in directions]
    names, at = np.unique(np.concatenate(before), return_inverse=True)
    member = np.zeros((len(directions), len(names)), "f4")
    member[np.repeat(np.arange(len(directions)), [len(b) for b in before]), at] = 1
    return member @ member.T == 0


def _unit_links(group, cosine: float, kind: str, code: str):
    """``node, links, to`` of one unit of work: links counted here, and the
    smallest node within reach."""
    import pandas as pd

    v = _unit(np.stack([np.frombuffer(x, kind) for x in group["vec"]]))
    linked = v @ v.T >= cosine
    np.fill_diagonal(linked, False)
    own = group["own"].to_numpy()
    if group["lo"].iloc[0] != group["hi"].iloc[0]:
        linked &= own[:, None] != own[None, :]
    i, j = np.nonzero(linked)
    if not len(i):
        return None
    node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
    label = node.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        if (new == label).all():
            break
        label = new
    codes = [np.frombuffer(d, code) for d in group["directions"]]
    fresh = linked & _first_shared(codes, int(group["direction"].iloc[0]))
    touched = np.unique(i)
    return pd.DataFrame({"node": node[touched], "links": (fresh @ copies)[touched], "to": label[touched]})


def _links(units: DataFrame, cosine: float, kind: str, n: int) -> DataFrame:
    code = "<i4" if code_size(n)[0] ** 2 < 1 << 31 else "<i8"

    def link(frames):
        for group in whole_groups(frames, ["key", "lo", "hi"]):
            found = _unit_links(group, cosine, kind, code) if len(group) > 1 else None
            if found is not None:
                yield found

    return units.mapInPandas(link, "node long, links long, to long")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``vectors``."""
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"  # singles are shipped as such, and compared as doubles
    v = F.col("embedding")
    fine = v.isNotNull() & F.col("label").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"),
                          F.col(label_col).cast("string").alias("label"))
    rows = rows.withColumn("node", F.when(fine, F.xxhash64("label", F.transform(v, lambda x: x + 0.0))))
    good = rows.filter("node IS NOT NULL")
    nodes = written(good.groupBy("node").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies")), "caps-nodes", narrow=True)
    once = good.dropDuplicates(["node"]).select("node", "label", "embedding")
    n = nodes.count()
    dealt = written(_filtered(once.join(nodes, "node"), kind, n), "caps-filters")
    shared = dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1") \
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    shared = written(shared, "caps-shared", narrow=True)
    units = dealt.join(shared, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}) \
        .select("key", "lo", "hi", "own", "node", "copies", "direction", "directions", "vec")
    units = units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "own", "node")
    links = written(_links(units, cosine, kind, n), "caps-links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    component = connected_components(links.select(F.col("node").alias("u"), F.col("to").alias("v")), "caps")
    placed = nodes.join(counts, "node", "left").join(component.withColumnRenamed("id", "node"), "node", "left") \
        .select("node", "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component"))
    placed = written(placed, "caps-placed", narrow=True)
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    by_node = written(placed.join(lowest, "component").select("node", "n_links", "component_id"), "caps-roots", narrow=True)
    out = rows.select("vec_id", "node").join(by_node, "node", "left")
    component_id = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id")) \
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_embedding_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


#: DuckDB form of the query: all pairs of a label
ORACLE_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_max(embedding) - list_min(embedding) + abs(list_max(embedding)) > 0),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS found FROM embeddings
  UNION SELECT reach.vec_id, link.v FROM reach JOIN link ON reach.found = link.u),
n AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN n ON n.u = e.vec_id
JOIN (SELECT vec_id, min(found) AS component_id FROM reach GROUP BY vec_id) c ON c.vec_id = e.vec_id
"""
