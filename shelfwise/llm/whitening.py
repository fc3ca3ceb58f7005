"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on the triangular factor.

Entries are put on a grid first, ``x = floor(64 * c) + 1000000``, so that equal
vectors are equal to the last bit and sums are exact.  The fit takes each distinct x
once: their number n and sums S, then the scatter of ``x - S/n`` (split into the whole
and the fractional part of the mean, so nothing large cancels), a partial sum a task,
added up row by row on Spark.  What the driver gets is one vector and one matrix of
the *dimension*; no row of the table.

The scatter A is factored with diagonal pivoting, ``A = L L'`` up to the order of the
rows, until no pivot is left above ``RANK`` of the largest variance.  Right rotations then make the columns of
L orthogonal: ``L J = U D``.  As ``A = L L' = U D^2 U'``, the squared column norms are
the eigenvalues of A and the normalised columns its eigenvectors; neither L'L nor any
other product is formed, so small eigenvalues keep their relative accuracy.

Defined cases: a vector that is NULL or has a NULL or non-finite entry is dropped, as
is an empty one, which has no component; the dimension is the commonest length
(ties: the longest) and vectors of another length are dropped; repeated rows are
returned each, and fitted once; a component whose eigenvalue is zero to rounding (constant
or dependent dimensions, fewer vectors than dimensions) is not returned, so
one distinct vector or an empty table gives no row; ``64 * c`` beyond 2**40 in
magnitude counts as 2**40; a ``deviation`` beyond a long is NULL.  Ties of equal
eigenvalues are ordered as the factorisation leaves them, the same for all rows.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import read_table, written

SCALE, SHIFT, LARGEST = 64, 1_000_000, float(1 << 40)
COMPONENTS = 16
#: a pivot below this share of the largest variance is rounding
RANK = 1e-12
#: entries of the vectors that one step of a task holds
STEP_ENTRIES = 1 << 20


def on_grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: the usable vectors of the commonest length, on the grid."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    lengths = rows.groupBy(F.size(v).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    rows = rows.filter(F.size(v) == (lengths[0]["length"] if lengths else 0))
    grid = F.transform(v, lambda c: F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c * SCALE))) + SHIFT)
    return rows.select("vec_id", grid.alias("x"))


def _matrices(batches, name: str = "x"):
    """The column ``name`` of lists of one length as matrices, with their batch."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index(name))
        dim = len(lists[0]) if len(lists) else 1
        for at in range(0, len(lists), step := max(1, STEP_ENTRIES // dim)):
            part = batch.slice(at, step)
            flat = part.column(part.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(-1, dim)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """n and the exact sums of each dimension."""
    def partial(batches):
        total = None
        for _, x in _matrices(batches):
            s = x.sum(0, dtype="i8")
            total, n = (s, len(x)) if total is None else (total + s, n + len(x))
        if total is not None:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(len(total)), "s": total, "n": np.full(len(total), n)})

    parts = fit.select("x").mapInArrow(partial, "dim long, s long, n long")
    total = parts.groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("dim").collect()
    return (total[0]["n"], [int(r["s"]) for r in total]) if total else (0, [])


def scatter(fit: DataFrame, column: str, centre, dim: int, label: str) -> np.ndarray:
    """Sum of the outer products of ``centre(rows)`` over all rows of ``fit``."""
    def partial(batches):
        total = np.zeros((dim, dim))
        for _, x in _matrices(batches, column):
            c = centre(x)
            total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(list(total))], names=["line", "cells"])

    def add(keys, table):
        cells = table.column("cells").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        return pa.table({"line": [keys[0].as_py()], "cells": pa.array([cells.sum(0)])})

    lines = fit.select(column).mapInArrow(partial, "line long, cells array<double>")
    lines = written(lines.groupBy("line").applyInArrow(add, "line long, cells array<double>"), label, narrow=True)
    out = np.zeros((dim, dim))
    for r in lines.collect():  # dim x dim
        out[r["line"]] = r["cells"]
    return (out + out.T) / 2


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L of as many columns as the rank, with ``L L' = a`` (its rows are triangular in
    the order of the pivots)."""
    rest, least = a.astype("f8").copy(), RANK * max(a.diagonal().max(initial=0.0), 0.0)
    columns = []
    for _ in range(len(a)):
        p = int(np.argmax(rest.diagonal()))
        if rest[p, p] <= least:
            break
        column = rest[:, p] / np.sqrt(rest[p, p])
        rest -= np.outer(column, column)
        rest[p, :] = rest[:, p] = 0.0
        columns.append(column)
    return np.array(columns).T.reshape(len(a), len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of ``factor @ factor.T``.

    In each round of a sweep the columns are rotated in disjoint pairs; after a
    sweep every two columns have met once."""
    u = factor.copy()
    k = u.shape[1]
    if k == 0:
        return np.zeros(0), u
    order = np.arange(k + k % 2)  # an odd number of columns gets an idle place
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(order) - 1):
            i, j = order[:len(order) // 2], order[len(order) // 2:][::-1]
            real = (i < k) & (j < k)
            i, j = i[real], j[real]
            a, b = u[:, i], u[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > 1e-16
            tau = (bb - aa)[turn] / (2 * ab[turn])
            t = np.where(tau >= 0, 1.0, -1.0) / (np.abs(tau) + np.hypot(1.0, tau))
            c = 1 / np.hypot(1.0, t)
            u[:, i[turn]], u[:, j[turn]] = c * a[:, turn] - c * t * b[:, turn], c * t * a[:, turn] + c * b[:, turn]
            order = np.r_[order[0], order[-1], order[1:-1]]
        if worst < 1e-15 * np.sqrt(len(u)):
            break
    value = (u * u).sum(0)
    fall = np.argsort(-value, kind="stable")
    return value[fall], u[:, fall] / np.sqrt(value[fall])


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each
    usable vector and each of the first ``components`` components."""
    spark = vectors.sparkSession
    schema = f"vec_id {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, " \
        "explained double, identity_error double"
    rows = on_grid(vectors, id_col, vector_col)
    fit = written(rows.select("x").distinct(), "whitening-fit")
    n, sums = _sums(fit)
    if n < 2:
        return spark.createDataFrame([], schema)
    dim = len(sums)
    whole = np.array([s // n for s in sums])
    part = np.array([s % n / n for s in sums])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole) - part

    spread = scatter(fit, "x", centred, dim, "whitening-scatter") / n
    value, vector = one_sided_jacobi(pivoted_cholesky(spread))
    value, vector = value[:components], vector[:, :components]
    if not len(value):
        return spark.createDataFrame([], schema)
    explained = (value / np.trace(spread)).tolist()
    project = vector / np.sqrt(value)
    k = len(value)

    def out_of(x: np.ndarray) -> np.ndarray:
        return np.einsum("ij,jk->ik", centred(x), project)  # equal rows to the last bit, wherever they stand

    middle = out_mean(fit, out_of, n, k)
    ident = scatter(fit, "x", lambda x: out_of(x) - middle, k, "whitening-identity") / n
    error = float(np.abs(ident - np.eye(k)).max())
    # (n * x - S) is n * (x - whole) - rest with whole and rest the quotient and the remainder of S by n
    rest = [s % n for s in sums]

    def emit(batches):
        fields = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        small = np.array(rest, "i8")
        for batch, x in _matrices(batches):
            off = x - whole
            reach = np.abs(off).max(initial=0)
            if dim * (n * (int(reach) + 1)) ** 2 < 1 << 63:
                deviation = ((n * off - small) ** 2).sum(1).tolist()
            else:
                exact = [sum((n * a - r) ** 2 for a, r in zip(line, rest)) for line in off.tolist()]
                deviation = [d if d < 1 << 63 else None for d in exact]
            w = out_of(x)
            m = len(x)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), m)), pa.array(np.full(m * k, n)),
                 pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], names=fields)

    return rows.mapInArrow(emit, schema)


def out_mean(fit: DataFrame, out_of, n: int, k: int) -> np.ndarray:
    """Mean of ``out_of(x)`` over the fit list (zero up to rounding)."""
    def partial(batches):
        total = np.zeros(k)
        for _, x in _matrices(batches):
            total += out_of(x).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(total)], names=["component", "s"])

    total = fit.select("x").mapInArrow(partial, "component long, s double").groupBy("component").agg(F.sum("s").alias("s"))
    return np.array([r["s"] for r in total.orderBy("component").collect()]) / n


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))
