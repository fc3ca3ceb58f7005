"""Spelling variants grouped under their most frequent form.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point.  Rather than joining words with words, each word's edits are generated where
the word is: every deletion, and every replacement by a later letter of the
alphabet, so that each near pair is generated once.  (An insertion is a deletion
seen from the longer word.)  An edit is probed against a *blocked Bloom filter* of
the vocabulary, one shard per word length; only edits that the filter may hold are
shuffled to an exact join with the vocabulary, which removes the false positives.
Words hash by a polynomial, so an edit's hash follows from its word's in a few
vectorised operations and no edit is spelled out unless it passes.

The filter takes ``BITS`` bits a word and is broadcast, but never more than
``FILTER_BYTES`` of it at a time: a larger one is cut into ranges of blocks, and each
pass probes the edits whose block lies in its range.  The passes together probe every
edit once, so the result does not depend on that bound.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least ``RATIO`` times its own; counts at least double
along a chain of forms, so following them ends, and the roots are found by pointer
doubling.

Defined cases: a NULL or empty text and one without letters hold no word; a NULL
``doc_id`` counts as empty text in the hash; rows that repeat count each time;
texts and words of any length are read whole (words over ``LONG`` letters share one
shard, with ``LONG_BITS`` bits a word, as they have many edits); an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import read_table, whole_groups, written

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: what lower-cased runs are made of
ALPHABET = LOWER + "".join(map(chr, range(0xC0, 0x100)))
MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
#: one occurrence in so many, picked by a hash, loses a letter
TYPO_EVERY = 97

BITS, LONG_BITS, LONG = 16, 64, 64
BLOCK_WORDS = 8  # a block is 8 words of 64 bits; an entry sets one bit in each
CHUNK_BLOCKS = 64
FILTER_BYTES = 32 << 20
#: words of the vocabulary whose edits one task probes
TASK_WORDS = 10_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_every: int = TYPO_EVERY) -> DataFrame:
    """``word``, a row for every run of letters, with the letters that ``typo_every`` takes away."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    typo = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % typo_every == 0, typo).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    return words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# --- hashes -------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _letters(code: np.ndarray) -> np.ndarray:
    return _mix(code.astype("u8") + _BASE)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE)
    out[:1] = 1
    return np.cumprod(out, dtype="u8")


def _by_length(words: list[str], most: int = 1 << 20):
    """``picks, codes``: the words of one length at a time as a matrix of code points
    of ``most`` entries or one row."""
    lengths = np.fromiter(map(len, words), "i8", len(words))
    for length in np.unique(lengths):
        picks = np.flatnonzero(lengths == length)
        for at in range(0, len(picks), step := max(1, most // int(length))):
            part = picks[at:at + step]
            yield part, np.array([words[i] for i in part], f"U{length}").view("u4").reshape(len(part), length)


class Layout:
    """Where the entries of a word length have their blocks."""

    def __init__(self, counts: dict[int, int]):
        self.first, self.blocks, total = {}, {}, 0
        for shard, n in sorted(counts.items()):
            bits = LONG_BITS if shard > LONG else BITS
            self.first[shard], self.blocks[shard] = total, max(1, -(-n * bits // (64 * BLOCK_WORDS)))
            total += self.blocks[shard]
        self.total = total

    def block(self, h: np.ndarray, length: int) -> np.ndarray | None:
        shard = min(length, LONG + 1)
        if shard not in self.first:
            return None
        return ((h >> np.uint64(32)) * np.uint64(self.blocks[shard]) >> np.uint64(32)).astype("i8") + self.first[shard]


def _bits(h: np.ndarray) -> np.ndarray:
    """The bit of each of a block's words."""
    g = _mix(h ^ _BASE)
    return (g[..., None] >> (np.uint64(6) * np.arange(BLOCK_WORDS, dtype="u8"))) & np.uint64(63)


# --- the filter ---------------------------------------------------------------

def _filter_chunks(vocab: DataFrame, layout: Layout) -> DataFrame:
    """``chunk, bits``: the filter in pieces of ``CHUNK_BLOCKS`` blocks."""
    schema = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("hash", pa.int64())])

    def place(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            for _, codes in _by_length(words):
                length = codes.shape[1]
                h = _mix((_letters(codes) * _powers(length)).sum(1, dtype="u8"))
                block = layout.block(h, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block // CHUNK_BLOCKS), pa.array((block % CHUNK_BLOCKS).astype("i4")), pa.array(h.view("i8"))], schema=schema)

    def build(frames):
        import pandas as pd

        for group in whole_groups(frames, ["chunk"]):
            bits = np.zeros((CHUNK_BLOCKS, BLOCK_WORDS), "u8")
            at = group["place"].to_numpy()
            one = np.uint64(1) << _bits(group["hash"].to_numpy().view("u8"))
            for k in range(BLOCK_WORDS):
                np.bitwise_or.at(bits[:, k], at, one[:, k])
            yield pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "bits": [bits.tobytes()]})

    placed = vocab.select("word").mapInArrow(place, "chunk long, place int, hash long")
    return placed.repartition("chunk").sortWithinPartitions("chunk").mapInPandas(build, "chunk long, bits binary")


def _may_hold(bits: np.ndarray, low: int, layout: Layout, h: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Indices into ``h`` (already mixed) of the entries the filter may hold, among
    those whose block is in the range that starts at ``low``."""
    block = layout.block(h, length)
    if block is None:
        return tuple(np.zeros(0, "i8") for _ in h.shape)
    block -= low
    alive = np.nonzero((block >= 0) & (block < len(bits)))
    block, g = block[alive], _mix(h[alive] ^ _BASE)
    for k in range(BLOCK_WORDS):
        hit = (bits[block, k] >> ((g >> np.uint64(6 * k)) & np.uint64(63))) & np.uint64(1) == 1
        alive, block, g = tuple(a[hit] for a in alive), block[hit], g[hit]
    return alive


def _candidates(vocab: DataFrame, layout: Layout, filter_bits, low: int, alphabet: str) -> DataFrame:
    """``word, n, near``: the edits that pass the filter's part from block ``low``."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string())])

    def probe(batches):
        bits = np.frombuffer(filter_bits.value, "u8").reshape(-1, BLOCK_WORDS)
        letters = np.array(sorted(set(alphabet)), "U1").view("u4")
        values = _letters(letters)
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for picks, codes in _by_length(words, 1 << 15):
                length = codes.shape[1]
                terms, power = _letters(codes), _powers(length)
                here = terms * power
                whole = here.sum(1, dtype="u8")
                found = []
                # deletions: of a run of one letter, its first place stands for all
                before = np.cumsum(here, 1, dtype="u8") - here
                shifted = terms[:, 1:] * power[:-1]
                after = np.zeros_like(here)
                after[:, :-1] = np.cumsum(shifted[:, ::-1], 1, dtype="u8")[:, ::-1]
                row, at = _may_hold(bits, low, layout, _mix(before + after), length - 1)
                first = (at == 0) | (codes[row, at] != codes[row, at - 1])
                row, at = row[first], at[first]
                if len(row):
                    rest = codes[row][np.arange(length) != at[:, None]].reshape(len(row), length - 1)
                    found.append((row, rest))
                # replacements by a later letter, one place after the other
                for i in range(length):
                    later = letters > codes[:, i, None]
                    edit = _mix((whole - here[:, i])[:, None] + values * power[i])
                    row, new = _may_hold(bits, low, layout, edit, length)
                    keep = later[row, new]
                    row, new = row[keep], new[keep]
                    if len(row):
                        other = codes[row]
                        other[:, i] = letters[new]
                        found.append((row, other))
                for row, near in found:
                    spelled = np.ascontiguousarray(near).view(f"U{near.shape[1]}").ravel().tolist()
                    at = picks[row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([words[i] for i in at]), pa.array([counts[i] for i in at]), pa.array(spelled)], schema=schema)

    return vocab.select("word", "n").mapInArrow(probe, "word string, n long, near string")


# --- the operator -------------------------------------------------------------

def near_pairs(vocab: DataFrame, alphabet: str = ALPHABET, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``word, n, near, near_n``, once for each pair of near words of ``vocab`` (``word, n``).

    ``alphabet`` names every letter that a word may hold."""
    spark = vocab.sparkSession
    shard = F.least(F.length("word"), F.lit(LONG + 1))
    counts = {r["shard"]: r["count"] for r in vocab.groupBy(shard.alias("shard")).count().collect()}  # LONG + 1 rows at most
    layout = Layout(counts)
    vocab = vocab.repartition(max(1, -(-sum(counts.values()) // TASK_WORDS)), "word")
    chunks = written(_filter_chunks(vocab, layout), "spelling-filter", narrow=True)
    per_pass = max(1, filter_bytes // (8 * BLOCK_WORDS * CHUNK_BLOCKS))  # chunks
    passed = None
    for at in range(0, -(-layout.total // CHUNK_BLOCKS), per_pass):
        blocks = min(per_pass * CHUNK_BLOCKS, layout.total - at * CHUNK_BLOCKS)
        bits = np.zeros((-(-blocks // CHUNK_BLOCKS), CHUNK_BLOCKS * BLOCK_WORDS), "u8")
        for r in chunks.filter(F.col("chunk").between(at, at + per_pass - 1)).collect():  # filter_bytes at most
            bits[r["chunk"] - at] = np.frombuffer(r["bits"], "u8")
        shared = spark.sparkContext.broadcast(bits.tobytes())
        found = written(_candidates(vocab, layout, shared, at * CHUNK_BLOCKS, alphabet), "spelling-candidates")
        shared.unpersist()
        passed = found if passed is None else passed.unionByName(found)
    if passed is None:
        passed = spark.createDataFrame([], "word string, n long, near string")
    return passed.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def spelling_groups(vocab: DataFrame, ratio: float = RATIO, alphabet: str = ALPHABET, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``vocab`` (``word, n``)."""
    vocab = written(vocab.select("word", "n"), "spelling-vocabulary", narrow=True)
    pair = F.explode(F.array(F.struct(F.col("word"), F.col("near"), F.col("near_n")),
                             F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    both = near_pairs(vocab, alphabet, filter_bytes).select(pair.alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    forms = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"))
    forms = written(forms, "spelling-forms", narrow=True)
    roots = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    moved = not roots.isEmpty()
    while moved:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")), "spelling-roots", narrow=True)
        moved = not roots.filter("moved").isEmpty()
        roots = roots.select("word", "root")
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(vocabulary(occurrences(read_table(spark, sf_dir, "documents"))))


#: DuckDB form of the query: crc32 byte by byte, near words by equal words with one letter left out
ORACLE_SQL = r"""
WITH RECURSIVE
bits AS (
  SELECT i, i AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT i, c FROM bits WHERE k = 8),
runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY 1, 2),
coded AS (SELECT id, run, times, hex(encode(id || ':' || run)) AS x FROM runs),
steps AS (
  SELECT id, run, times, x, 0 AS k, 4294967295 AS c FROM coded
  UNION ALL
  SELECT s.id, s.run, s.times, s.x, s.k + 1, xor(s.c // 256, t.c)
  FROM steps s JOIN crc_table t ON t.i = xor(s.c % 256, 16 * (strpos('0123456789ABCDEF', substr(s.x, 2 * s.k + 1, 1)) - 1)
                                             + strpos('0123456789ABCDEF', substr(s.x, 2 * s.k + 2, 1)) - 1)
  WHERE 2 * s.k < length(s.x)),
hashed AS (SELECT run, times, xor(c, 4294967295) AS h FROM steps WHERE 2 * k = length(x)),
said AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, times
  FROM hashed),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM said WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS BIGINT) AS i FROM v)),
pairs AS (
  SELECT p.word, q.word AS near, q.n AS near_n FROM cut p JOIN cut q ON p.a = q.a AND p.b = q.b AND p.word <> q.word
  UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = a || b
  UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = a || b),
best AS (
  SELECT word, near, near_n, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r, count(*) OVER (PARTITION BY word) AS n_near
  FROM pairs),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word AND r = 1),
chain AS (
  SELECT word, word AS at_word FROM forms
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at_word WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, c.at_word AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms last ON last.word = c.at_word AND last.form IS NULL
"""
