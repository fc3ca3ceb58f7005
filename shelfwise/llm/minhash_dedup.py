"""Near-duplicate documents by HyperMinHash.

1. A document's set is its distinct word shingles, as 64-bit hashes.  Documents
   with equal sets form one class, known by 128 bits of the set's hash and, once the
   table of classes is written, by a number.
2. The set is dealt into ``REGISTERS`` buckets by the top bits of the hash.  A
   register keeps the bucket's smallest hash in 16 bits: how many leading zeros
   it has, and its next ten bits (mantissa).  Bands of registers are hashed;
   an empty register borrows that of a bucket drawn by a fixed sequence, so
   short documents band like long ones.  42 bands of 6 find a pair of
   similarity 0.8 with probability above 0.99999.
3. Classes that share a band key are candidates.  Each bucket first compares all
   its members with two pivots (its smallest and largest number).  Buckets of at
   most three members, and those whose members then fall in one component, are done.
   In the others members of different components are compared in full, block by
   block; a pair is compared only in the first bucket it shares, which its registers
   tell, so no link is lost to the pivots and no pair is compared twice.
4. A candidate pair is dropped when the set sizes exclude the similarity, or
   when the Jaccard estimate from its registers, corrected for registers that
   agree by chance, lies 4.5 standard deviations below it.  Every other pair is
   verified on the full sets.
5. Links become components, known by their smallest document id.

Defined cases: fewer words than a shingle takes: the whole sequence is the one
shingle; NULL, empty or blank text: empty set, linked with nothing; texts of any
length are read whole; repeated rows share their class; rows of one id with different
texts are documents of their own, each in the component of its text; a component
without any id has a NULL component_id and its rows are kept; ties: of equal
smallest ids all rows are kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, connected_components, in_own_names, read_table, whole_groups, worker_state, written

REGISTERS = 256
MANTISSA_BITS = 10
BANDS, BAND_ROWS = 42, 6
SIGMAS = 4.5
CACHE_WORDS = 50_000  # hashing a word again costs little
BLOCK_DOCS, BLOCK_SHINGLES = 256, 500_000

_U = np.uint64


def _mix(x):
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class _WordHashes(dict):
    def __missing__(self, word):
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, "u8")
    hashes = worker_state("minhash:words", _WordHashes)
    w = np.fromiter(map(hashes.__getitem__, words), "u8", len(words))
    if len(w) < size:
        h = np.full(1, len(w), "u8")
        for x in w:
            h = _mix(h * _U(0x9E3779B97F4A7C15) + x)
        return h
    h = w[:len(w) - size + 1].copy()
    for k in range(1, size):
        h = h * _U(0x9E3779B97F4A7C15) + w[k:len(w) - size + 1 + k]
    return np.unique(_mix(h + _U(size)))


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set; 0 marks an empty bucket."""
    bits = REGISTERS.bit_length() - 1
    starts = np.arange(REGISTERS, dtype="u8") << _U(64 - bits)
    at = np.searchsorted(shingles, starts)
    ends = np.append(at[1:], len(shingles))
    full = at < ends
    out = np.zeros(REGISTERS, "u2")
    rest = shingles[at[full]] & ((_U(1) << _U(64 - bits)) - _U(1))
    fraction, exponent = np.frexp(rest.astype("f8"))
    zeros = np.where(rest == 0, 64 - bits, 64 - bits - exponent)
    mantissa = np.where(rest == 0, 0, ((2 * fraction - 1) * (1 << MANTISSA_BITS)).astype("i8"))
    out[full] = zeros * (1 << MANTISSA_BITS) + mantissa + 1
    return out


def _borrowed(draw: int) -> np.ndarray:
    """The bucket that each register borrows from at a draw."""
    at = np.arange(REGISTERS, dtype="u8") + _U(draw * REGISTERS)
    return (_mix(at * _U(0x9E3779B97F4A7C15) + _U(7)) % _U(REGISTERS)).astype("i8")


def band_keys(registers: np.ndarray) -> np.ndarray:
    """``[n, REGISTERS]`` registers to ``[n, BANDS]`` keys."""
    filled = registers.copy()
    row, col = np.nonzero((registers == 0) & registers.any(1)[:, None])  # an empty set stays so
    draw = 0
    while len(row):
        got = registers[row, _borrowed(draw)[col]]
        filled[row, col] = got
        row, col = row[got == 0], col[got == 0]
        draw += 1
    rows = filled[:, :BANDS * BAND_ROWS].reshape(len(filled), BANDS, BAND_ROWS).astype("u8")
    key = np.broadcast_to(np.arange(BANDS, dtype="u8"), rows.shape[:2]).copy()
    for k in range(BAND_ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + rows[:, :, k])
    return key.view("i8")


def chance_agreements() -> np.ndarray:
    """``[a, b]``: expected number of registers in which two unrelated sets of
    ``2 ** (a / 2)`` and ``2 ** (b / 2)`` elements agree by chance."""
    steps = 1 << MANTISSA_BITS
    zeros = np.arange(0, 64 - REGISTERS.bit_length() + 1)[:, None]
    low = (1 + np.arange(steps) / steps) * 0.5 ** (zeros + 1)
    high = low + 0.5 ** (zeros + 1) / steps
    out = []
    for half in range(0, 49):
        n = 2 ** (half / 2)
        keep = lambda cut: np.exp(n * np.log1p(-cut / REGISTERS))  # noqa: E731  no element of the bucket below the cut
        out.append((keep(low) - keep(high)).ravel())
    cells = np.asarray(out)
    return REGISTERS * cells @ cells.T


def estimated_jaccard(a, b, size_a, size_b, chance):
    """Jaccard estimates of register rows and their standard deviation at 0.8."""
    both = ((a == b) & (a > 0)).sum(1)
    union = ((a > 0) | (b > 0)).sum(1)
    ga = np.clip(np.rint(2 * np.log2(np.maximum(size_a, 1))), 0, 48).astype("i8")
    gb = np.clip(np.rint(2 * np.log2(np.maximum(size_b, 1))), 0, 48).astype("i8")
    share = (both - chance[ga, gb]) / np.maximum(union, 1)
    return share, np.sqrt(0.16 / np.maximum(union, 1))


def text_key(text) -> list:
    """128 bits of a text."""
    return [F.xxhash64(text, F.length(text)).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``doc_id, t1, t2, n_shingles, k1, k2, registers`` of every row; t1 and t2 are
    128 bits of the text's hash, k1 and k2 of the set's."""
    schema = pa.schema([("doc_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("n_shingles", pa.int64()),
                        ("k1", pa.int64()), ("k2", pa.int64()), ("registers", pa.binary())])

    def sign(batches):
        import xxhash

        for batch in batches:
            n, k1, k2, regs = [], [], [], []
            for text in batch.column(3):
                s = shingle_set(text.as_py(), size)
                k = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
                n.append(len(s))
                k1.append(k[0])
                k2.append(k[1])
                regs.append(registers_of(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(regs, pa.binary())], schema=schema)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *text_key(text), text.alias("text")) \
        .mapInArrow(sign, "doc_id long, t1 long, t2 long, n_shingles long, k1 long, k2 long, registers binary")


def _bands(classes: DataFrame) -> DataFrame:
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def deal(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                regs = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u2").reshape(-1, REGISTERS)
                keys = band_keys(regs)
                ids = np.repeat(part.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], schema=schema)

    return classes.select("node", "registers").mapInArrow(deal, "key long, node long")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` that set sizes and register estimates don't exclude."""
    def side(x):
        return classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def estimate(batches):
        chance = worker_state("minhash:chance", chance_agreements)
        for batch in batches:
            col = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            ra, rb = (np.frombuffer(b"".join(col[c].to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
            share, sd = estimated_jaccard(ra, rb, col["n_a"].to_numpy(), col["n_b"].to_numpy(), chance)
            ok = share + SIGMAS * sd >= percent / 100
            yield pa.RecordBatch.from_arrays([col["a"].filter(pa.array(ok)), col["b"].filter(pa.array(ok))], schema=schema)

    return joined.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(estimate, "a long, b long")


def _set_table(docs: DataFrame, text_col: str, wanted: DataFrame, size: int) -> DataFrame:
    """``node, set``: sorted shingle hashes of the wanted classes (``t1, t2, node``).

    One row for each text, combined map-side, comes first, so the copies of a text
    don't meet in a task."""
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary())])

    def shingle(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(t.as_py(), size).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], schema=schema)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    once = docs.select(*text_key(text), text.alias("text")).dropDuplicates(["t1", "t2"])
    return once.join(wanted, ["t1", "t2"]).select("node", "text").mapInArrow(shingle, "node long, set binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have ``100 * intersection >= percent * union``."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def confirm(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), "u8") for v in (a, b))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            ok = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], schema=schema)

    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("s_a")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("s_b")), "b")
    return joined.select("a", "b", "s_a", "s_b").mapInArrow(confirm, "u long, v long")


def _links_across(members: DataFrame, component: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that a bucket of more than three members brings together.

    A bucket is cut into blocks bounded in members and in shingles; a unit of work
    holds the sets of two blocks and compares all its pairs of different components
    that share no earlier bucket: registers first, then the full sets.
    """
    placed = members.join(component.withColumnRenamed("id", "node"), "node", "left") \
        .select("key", "node", F.coalesce("component", "node").alias("component")).join(classes.select("node", "n"), "node")
    placed = written(placed, "minhash-placed", narrow=True)
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"),
                                      blocks.alias("blocks")).filter("lo < hi AND m > 3").select("key", "blocks")
    units = placed.join(written(mixed, "minhash-mixed", narrow=True), "key").join(sets, "node") \
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "component", "set")

    def compare(frames):
        import pandas as pd

        chance = worker_state("minhash:chance", chance_agreements)
        for unit in whole_groups(frames, ["key", "lo", "hi"]):
            ids, comp, own = (unit[c].to_numpy() for c in ("node", "component", "own"))
            own_set = [np.frombuffer(x, "u8") for x in unit["set"]]
            n = np.array([len(x) for x in own_set])
            regs = np.stack([registers_of(x) for x in own_set])
            bands = band_keys(regs)
            before = int(np.flatnonzero(bands[0] == unit["key"].iloc[0])[0])  # the same band for all members
            lo, hi = unit["lo"].iloc[0], unit["hi"].iloc[0]
            u, v = [], []
            for i, x in enumerate(own_set):
                j = np.flatnonzero((comp != comp[i]) & (ids > ids[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
                                   & ((own != own[i]) if lo != hi else True))
                j = j[~(bands[j, :before] == bands[i, :before]).any(1)]
                if len(j):
                    share, sd = estimated_jaccard(regs[j], regs[i], n[j], np.full(len(j), n[i]), chance)
                    j = j[share + SIGMAS * sd >= percent / 100]
                for k in j:
                    y = own_set[k]
                    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        u.append(ids[i])
                        v.append(ids[k])
            yield pd.DataFrame({"u": np.array(u, "i8"), "v": np.array(v, "i8")})

    units = units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "node")
    return units.mapInPandas(compare, "u long, v long")


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The written signatures of all rows, and ``k1, k2, root``: the number of each
    class's component."""
    signed = written(signatures(docs, id_col, text_col, shingle_words), "minhash-signatures")
    # one row per class and task leaves the map side; equal sets have equal registers
    classes = signed.filter("n_shingles > 0").groupBy("k1", "k2") \
        .agg(F.min(F.struct("t1", "t2")).alias("t"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
    classes = written(classes.select("k1", "k2", "t.t1", "t.t2", "n", "registers", F.monotonically_increasing_id().alias("node")), "minhash-classes")

    banded = written(_bands(classes), "minhash-bands")
    pivots = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    pivots = written(pivots, "minhash-pivots", narrow=True)  # a plain join input, so Spark may split a hot bucket
    members = written(banded.join(pivots, "key"), "minhash-members")
    to_low = members.filter("node > low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    to_high = members.filter("node < high").select(F.col("node").alias("a"), F.col("high").alias("b"))
    members = members.select("key", "node")
    wanted = classes.select("t1", "t2", "node").join(members.select("node").distinct(), "node")
    sets = written(_set_table(docs, text_col, wanted, shingle_words), "minhash-sets")
    tried = written(to_low.unionByName(to_high).distinct(), "minhash-pairs", narrow=True)
    links = written(_verified(written(_plausible(tried, classes, percent), "minhash-plausible"), sets, percent), "minhash-links")
    component = connected_components(links, "minhash")
    more = written(_links_across(members, component, classes, sets, percent), "minhash-links")
    if not more.isEmpty():
        component = connected_components(links.unionByName(more), "minhash")
    roots = classes.select("k1", "k2", "node").join(component.withColumnRenamed("id", "node"), "node", "left")
    return signed, written(roots.select("k1", "k2", F.coalesce("component", "node").alias("root")), "minhash-roots", narrow=True)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``."""
    signed, roots = grouped(docs, id_col, text_col, shingle_words, percent)
    lowest = signed.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("low")).join(roots, ["k1", "k2"])
    lowest = written(lowest, "minhash-lowest", narrow=True)
    least = lowest.groupBy("root").agg(F.min("low").alias("least"))
    lookup = written(lowest.join(least, "root").select("k1", "k2", "least"), "minhash-lookup", narrow=True)
    out = signed.select("doc_id", "n_shingles", "k1", "k2").join(lookup, ["k1", "k2"], "left")
    component_id = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row, with the columns of ``docs``, of each group of near-duplicates: that of
    the smallest id (NULL last), of equal ids the text of smallest hash.  Texts, not
    ids, are compared, so rows without an id or of one id stay apart; of rows of equal
    id and text the smallest stays.  Blank texts are no duplicates of each other: of
    them only rows equal in every column become one."""
    def step(inner, id_col, text_col):
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        keyed = inner.select("*", *text_key(text))
        wordy = text.rlike(WORD)
        signed, roots = grouped(inner.filter(wordy), id_col, text_col, shingle_words, percent)
        order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
        best = signed.groupBy("k1", "k2").agg(F.min(order).alias("best")).join(roots, ["k1", "k2"])
        first = best.groupBy("root").agg(F.min("best").alias("f")).select(F.col("f.doc_id").alias("_id"), F.col("f.t1").alias("t1"), F.col("f.t2").alias("t2"))
        first = written(first, "minhash-first", narrow=True)
        kept = keyed.filter(wordy).alias("d").join(
            first.alias("f"), (F.col("d.t1") == F.col("f.t1")) & (F.col("d.t2") == F.col("f.t2"))
            & F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("f._id")), "left_semi")
        kept = kept.groupBy("t1", "t2", id_col).agg(F.min(F.struct(*[F.col(c).alias(f"_{c}") for c in inner.columns])).alias("_row"))
        return kept.select(*[F.col(f"_row._{c}").alias(c) for c in inner.columns]).unionByName(inner.filter(~wordy).distinct())

    return in_own_names(docs, step, id_col=id_col, text_col=text_col)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=4)


#: DuckDB form of the query: every pair that shares a shingle is compared
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT u, v FROM shared JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v WHERE 100 * n_shared >= 80 * (p.n + q.n - n_shared)),
edge AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (
  SELECT doc_id, doc_id AS found FROM documents
  UNION SELECT reach.doc_id, edge.v FROM reach JOIN edge ON reach.found = edge.u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(found) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""
