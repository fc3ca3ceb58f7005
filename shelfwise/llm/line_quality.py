"""Quality rules: text counts, and lines that many documents of one host share.

Base rules look at one text: how many words, and how many of them stand in
five-word windows that the text repeats.

Cross-document rule: the lines of a text are normalised (lower case, white space
collapsed) and hashed.  A line that more than ``MAX_DOCUMENTS`` distinct documents of
one host hold is boilerplate there, whatever the size of the host or the corpus; copies
of a text are documents of their own and count.  Boilerplate lines are removed; a
document that keeps fewer than ``MIN_LEFT`` percent of its words is depleted and rejected.

Lines are marked by a join on (host, line).  A line with more than a ten-thousandth of
all line rows (there are fewer than ten thousand) is looked up by broadcast, so no line
gathers in a task; the others meet by an ordinary join.
Every step is a DataFrame expression or a map-side combined aggregate.

Defined cases: NULL, empty and blank texts have no words and fail the base rule;
NULL is a host of its own, and a NULL id one document; texts of any length are read
whole; rows that repeat id, host and text get one verdict and count once; a document
with exactly ``MIN_LEFT`` percent left is kept, a line in exactly ``MAX_DOCUMENTS``
stays; an empty table gives no rows; other columns pass through, but ``judge`` replaces
columns named like its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import GAP, in_own_names, read_table, words_of, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW_WORDS = 5
MAX_DOCUMENTS = 50
MIN_LEFT = 30
#: a line with more than one in so many line rows is looked up by broadcast
HOT_SHARE = 10_000
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a five-word window found twice or more.

    Window hashes are sorted on their own first; only a text that repeats one
    sorts them with their positions.
    """
    def hashes(w):
        return F.transform(w, lambda x: F.xxhash64(x))

    def windows(h):
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW_WORDS),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW_WORDS)]))

    def has_equal(sorted_hashes):
        return F.exists(F.sequence(F.lit(1), F.size(sorted_hashes) - 1),
                        lambda i: F.get(sorted_hashes, i) == F.get(sorted_hashes, i - 1))

    def covered(win):
        placed = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def twice(p):
            def same(x, j):
                before, after = F.get(p, j - 1), F.get(p, j + 1)
                return F.coalesce(x["h"] == before["h"], F.lit(False)) | F.coalesce(x["h"] == after["h"], F.lit(False))

            return F.sort_array(F.transform(F.filter(p, same), lambda x: x["at"]))

        start = F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            bind(placed, twice), start,
            lambda s, at: F.struct(at.alias("last"), (s["n"] + F.least(F.lit(WINDOW_WORDS), at - s["last"])).alias("n")),
            lambda s: s["n"])

    def count(win):
        return F.when(F.size(win) < 2, F.lit(0)).when(bind(F.sort_array(win), has_equal), covered(win)).otherwise(F.lit(0))

    return F.when(F.size(words) < WINDOW_WORDS, F.lit(0)).otherwise(bind(bind(hashes(words), windows), count))


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts and ``base_failed``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(F.translate(x, BLANKS, " "))) > 0)
    counted = docs.withColumn("_words", words_of(text)).withColumn("_lines", lines).withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")).cast("long")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).drop("_words", "_lines")


def normal_line(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, GAP, " ")))


def _row_key(docs: DataFrame, host_col: str, text_col: str, id_col: str) -> DataFrame:
    """``docs`` with ``_k1, _k2``: 128 bits that rows of equal id, host and text share."""
    host, text, doc = F.col(host_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col)
    return docs.withColumns({"_k1": F.xxhash64(doc.isNull(), doc, host.isNull(), host, text),
                             "_k2": F.xxhash64(F.length(text), text, F.lit(7), host, doc)})


def host_lines(docs: DataFrame, host_col: str, text_col: str, id_col: str) -> DataFrame:
    """``_k1, _k2, _doc, _at, _h1, _h2, _n``: the lines that hold a word, by the key of
    their row: the document, the place, the hash of host and normalised line, the words."""
    host = F.col(host_col)
    places = F.posexplode(F.transform(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n"), normal_line))
    lines = _row_key(docs, host_col, text_col, id_col).select(
        "_k1", "_k2", F.xxhash64(F.col(id_col).isNull(), id_col).alias("_doc"), host.alias("_host"), places.alias("_at", "_line"))
    return lines.filter("_line <> ''").select(
        "_k1", "_k2", "_doc", "_at", F.xxhash64(F.col("_host").isNull(), "_host", "_line").alias("_h1"),
        F.xxhash64("_line", F.lit(1), "_host").alias("_h2"), F.size(F.split("_line", " ")).alias("_n"))


def removed_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
                  max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``_k1, _k2, _lines, _lost, _gone`` of the rows (by key) with boilerplate: how many
    lines and words go, and the hashes of those lines."""
    lines = written(host_lines(docs, host_col, text_col, id_col), "lines-all")
    by_doc = lines.groupBy("_h1", "_h2", "_doc").agg(F.count("*").alias("_rows"))
    common = by_doc.groupBy("_h1", "_h2").agg(F.count("*").alias("_docs"), F.sum("_rows").alias("_rows"))
    common = written(common.filter(F.col("_docs") > max_documents), "lines-common", narrow=True)
    least = lines.count() // HOT_SHARE
    hot = common.filter(F.col("_rows") > least).select("_h1", "_h2", F.lit(True).alias("_hot"))  # HOT_SHARE rows at most
    rest = common.filter(F.col("_rows") <= least).select("_h1", "_h2")
    looked_up = lines.join(F.broadcast(hot), ["_h1", "_h2"], "left")
    marked = looked_up.filter("_hot").drop("_hot").unionByName(looked_up.filter("_hot IS NULL").drop("_hot").join(rest, ["_h1", "_h2"]))
    once = marked.select("_k1", "_k2", "_at", "_h1", "_n").distinct()  # rows that repeat hold the same lines
    return once.groupBy("_k1", "_k2").agg(F.count("*").alias("_lines"), F.sum("_n").alias("_lost"), F.collect_set("_h1").alias("_gone"))


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text", id_col: str = "doc_id", min_left: int = MIN_LEFT,
          max_documents: int = MAX_DOCUMENTS, keep_hashes: bool = False) -> DataFrame:
    """``docs`` with the base counts, ``n_removed_lines``, ``n_left_words`` and ``kept``
    (with ``keep_hashes`` also ``_gone``, the hashes of the removed lines)."""
    removed = removed_lines(docs, host_col, text_col, id_col, max_documents)
    removed = written(removed if keep_hashes else removed.drop("_gone"), "lines-removed", narrow=True)
    out = text_counts(_row_key(docs, host_col, text_col, id_col), text_col).join(removed, ["_k1", "_k2"], "left").withColumns({
        "n_removed_lines": F.coalesce("_lines", F.lit(0)).cast("long"),
        "n_left_words": F.col("n_words") - F.coalesce("_lost", F.lit(0))})
    depleted = (F.col("n_removed_lines") > 0) & (100 * F.col("n_left_words") < min_left * F.col("n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("_k1", "_k2", "_lines", "_lost")


def remove_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", id_col: str = "doc_id", **limits) -> DataFrame:
    """The kept documents, without their boilerplate lines, with the columns of ``docs``."""
    def cut(inner, host_col, text_col, id_col):
        host = F.col(host_col)
        kept = judge(inner, host_col, text_col, id_col, keep_hashes=True, **limits).filter("kept")
        stays = lambda x: ~F.array_contains(F.col("_gone"), F.xxhash64(host.isNull(), host, normal_line(x)))
        short = F.array_join(F.filter(F.split(F.col(text_col), "\n"), stays), "\n")
        return kept.withColumn(text_col, F.when(F.col("n_removed_lines") > 0, short).otherwise(F.col(text_col)))

    return in_own_names(docs, cut, host_col=host_col, text_col=text_col, id_col=id_col)


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                              "kept", "n_removed_lines", "n_left_words")


#: DuckDB form of the query (the limits above, spelled out)
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, generate_subscripts(ws, 1) AS p, unnest(ws) AS word
  FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
win AS (
  SELECT r, p, lead(word, 4) OVER o AS last, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o,
         lead(word, 3) OVER o, lead(word, 4) OVER o) AS five
  FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
twice AS (
  SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before
  FROM (SELECT r, p, count(*) OVER (PARTITION BY r, five) AS n FROM win WHERE last IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, sum(least(5, p - coalesce(before, p - 5))) AS n FROM twice GROUP BY r),
l AS (
  SELECT r, doc_id, source, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS normal,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l WHERE n > 0 GROUP BY r),
shared AS (
  SELECT source, normal FROM l WHERE normal <> '' GROUP BY source, normal
  HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) > 50),
gone AS (
  SELECT r, count(*) AS lines, sum(n) AS words
  FROM l JOIN shared s ON l.source IS NOT DISTINCT FROM s.source AND l.normal = s.normal GROUP BY r),
c AS (
  SELECT d.r, doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         coalesce(gone.lines, 0) AS n_removed_lines, coalesce(gone.words, 0) AS lost
  FROM d LEFT JOIN dup ON d.r = dup.r LEFT JOIN rep ON d.r = rep.r LEFT JOIN gone ON d.r = gone.r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
        AND NOT (n_removed_lines > 0 AND 100 * (n_words - lost) < 30 * n_words)) AS kept,
       n_removed_lines::BIGINT AS n_removed_lines, (n_words - lost)::BIGINT AS n_left_words
FROM c
"""
