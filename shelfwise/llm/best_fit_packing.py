"""Best-fit packing by large-item matching.

Documents are tokenised, cut into pieces of at most ``capacity`` tokens, and
packed into sequences:

* pieces above a third of the capacity go at most two to a sequence, matched
  greedily (the longest with the longest that still fits);
* smaller pieces, longest first, fill the smallest remaining gap that takes
  them; a new sequence is opened only when none does.

Lengths are whole numbers up to ``capacity``, so the *plan* depends only on how
many pieces have each length: a histogram of at most ``capacity`` rows, whatever
the corpus size.  The driver plans on that histogram; pieces then find their
place by their rank among pieces of equal length.  Ranks are counted per
(length, salt) with enough salts (``SALTS`` at least) that a length which a third of all
pieces share is cut into groups of about ``SALT_ROWS`` pieces at any size.

Defined cases: NULL or empty text is the end token alone; a text of any length is
read whole and cut into pieces; pieces of equal length rank by salt, id and piece,
and what is then equal is interchangeable; a repeated row is packed as often as it
occurs; an empty table gives no rows; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import bisect
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import read_table, worker_state, written

CAPACITY = 4096
END_ID = 1
#: pieces of one length and salt, on average, if all pieces had one length
SALTS, SALT_ROWS = 64, 20_000
#: entries that one generation of a worker's word and subword caches holds
CACHE_WORDS, CACHE_PARTS = 250_000, 250_000

PLACED = "sequence_id long, offset long"
#: the pre-tokenisation rule of the vocabulary file (fixed value)
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Aging(dict):
    """A bounded cache: when full, it becomes the old generation, from which
    entries still in use are carried over."""

    def __init__(self, make, limit):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    White space never joins two tokens of this vocabulary, so a text's ids are
    the ids of its words in order; words repeat, so each is encoded once per
    worker.  A word of characters below U+0250 is lower-cased, split by the
    vocabulary's rule (letters alone are one part, as is a last character behind
    them) and its parts are encoded by the BPE model; any other
    word, and any text with separators that Python alone calls white space, goes
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.split = regex.compile(PARTS).findall
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.byte_chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.odd = regex.compile(r"[\x1c-\x1f]").search
        self.words = _Aging(self._word, CACHE_WORDS)
        self.parts = _Aging(self._part, CACHE_PARTS)

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        tokens = self.model.tokenize(part.encode().decode("latin-1").translate(self.byte_chars))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def _word(self, word: str) -> bytes:
        if not word.isascii() and (max(word) >= "ɐ" or "İ" in word):
            return self._whole(word)
        low, parts = word.lower(), self.parts
        if low.isalpha():
            return parts[low]
        if low[:-1].isalpha():
            return parts[low[:-1]] + parts[low[-1]]
        if "<|" in word:
            return self._whole(word)
        return b"".join([parts[p] for p in self.split(low)])

    def __call__(self, text: str) -> bytes:
        if self.odd(text):
            return self._whole(text)
        return b"".join([self.words[w] for w in text.split()])


def tokenise_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY, end_id: int = END_ID, as_crc: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids``: each document's ids with the end
    token, cut into pieces of ``capacity`` (the last may be shorter).  With
    ``as_crc`` the checksum ``ids_crc32`` stands for the ids, which never leave the task."""
    name, kind, arrow = ("ids_crc32", "long", pa.int64()) if as_crc else ("ids", "binary", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), (name, arrow)])

    def cut(batches):
        encode = worker_state(f"encoder:{vocabulary}", lambda: Encoder(vocabulary))
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at:at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(piece) // 4, zlib.crc32(piece) if as_crc else piece))
                size += len(ids)
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(cut, f"doc_id long, piece int, start long, length long, {name} {kind}")


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """The packing plan as runs ``(length, first rank, ranks, first sequence,
    offset, pieces per sequence)``; at most ``capacity`` lengths go in."""
    plan: list[tuple[int, int, int, int, int, int]] = []
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, count)
    open_gaps: list[int] = []
    sequences = 0

    def put(length, count, first, offset, per=1):
        plan.append((length, used[length], count, first, offset, per))
        used[length] += count
        left[length] -= count

    def leave(gap, first, count):
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(open_gaps, gap)
            gaps[gap].append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large[:]):
        while left[length]:
            fits = bisect.bisect_right(large, min(capacity - length, length))
            while fits and not left[large[fits - 1]]:
                fits -= 1
            mate = large[fits - 1] if fits else None
            if mate is None or (mate == length and left[length] == 1):
                count, mate = left[length], None
            else:
                count = left[length] // 2 if mate == length else min(left[length], left[mate])
            first, sequences = sequences, sequences + count
            put(length, count, first, 0)
            if mate is not None:
                put(mate, count, first, length)
            leave(capacity - length - (mate or 0), first, count)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(open_gaps, length)
            if at == len(open_gaps):
                count = -(-left[length] // (capacity // length))
                leave(capacity, sequences, count)
                sequences += count
                continue
            gap = open_gaps[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                open_gaps.pop(at)
            per = gap // length
            full = min(count, left[length] // per)
            if full:
                put(length, full * per, first, capacity - gap, per)
                leave(gap - per * length, first, full)
            elif left[length]:
                rest = left[length]
                put(length, rest, first, capacity - gap, rest)
                leave(gap - rest * length, first, 1)
                full = 1
            leave(gap, first + full, count - full)
    return plan


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``pieces`` (``doc_id, piece, start, length`` and any other columns) with
    ``sequence_id`` and ``offset``.  ``pieces`` is read three times, so it
    should be a written table."""
    salts = max(SALTS, -(-pieces.count() // salt_rows))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counted = written(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most capacity rows
    plan = sorted(plan_sequences(histogram, capacity))
    runs = np.asarray(plan or [(0, 0, 0, 0, 0, 1)], "i8")
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counted.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("_row", F.row_number().over(within)).join(ahead, ["length", "_salt"]) \
        .withColumn("_rank", F.col("_ahead") + F.col("_row") - 1)

    @F.pandas_udf(PLACED)
    def place(length, rank):
        import pandas as pd

        base = np.int64(1) << 42
        at = np.searchsorted(runs[:, 0] * base + runs[:, 1], length.to_numpy() * base + rank.to_numpy(), "right") - 1
        run = runs[at]
        nth = rank.to_numpy() - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + nth // run[:, 5],
                             "offset": run[:, 4] + (nth % run[:, 5]) * run[:, 0]})

    return ranked.withColumn("_at", place("length", "_rank")) \
        .withColumn("sequence_id", F.col("_at.sequence_id")).withColumn("offset", F.col("_at.offset")) \
        .drop("_salt", "_row", "_ahead", "_rank", "_at")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ids and place: ``doc_id, piece, start, length, ids,
    sequence_id, offset``."""
    return place_pieces(written(tokenise_pieces(docs, vocabulary, capacity=capacity), "pack-pieces"), capacity)


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    pieces = written(tokenise_pieces(docs, vocabulary, as_crc=True), "pack-digests")
    return place_pieces(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(read_table(spark, sf_dir, "documents"), vocabulary_path())
