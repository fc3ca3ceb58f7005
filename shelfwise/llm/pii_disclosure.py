"""Personal data: pattern spans, and terms that disclose protected entities.

Base spans are e-mail addresses, IPv4 addresses, card numbers and phone numbers,
found by pattern and checked (range, digit count, Luhn).  Their values are the
protected *entities*.

A term (a run of letters outside base spans; in Latin letters of at least
``MIN_TERM_CHARS``) may give away an entity of the same text by itself.  Over the N
distinct texts of the corpus, with ``df`` the number of whole texts that hold a term or an
entity and ``co`` those that hold both (the term outside base spans), the term's disclosure is the information it
yields on the entity, ``log2(p(entity | term) / p(entity))`` bits, with
``p(entity | term) = co / df(term)``.

A co-occurrence is evidence only as far as chance does not explain it, and most words
that stand once beside an address do so by chance.  The *null model* deals every term
of the corpus at random to as many texts as it has, each text drawn in proportion to its
distinct terms.  ``chance`` is the number of terms of the same ``df`` that would then
stand in ``co`` of the entity's texts: ``T(df) * df ** (df - co) * q ** co``, where T counts
the corpus's terms by df and q is the share of all (term, text) incidences that lies in the
entity's texts (the power of df bounds the ways to choose the texts).  Where the term stands
within ``NEAR`` characters of a base span the same is reckoned with those near places alone
(their own co and q), which are fewer, and the smaller chance counts.  One disclosing term
against so many chance ones leaves the certainty ``p(entity | term) / (1 + chance)``.  So a
name that stands in several texts of one address is certain; a word found in one text alone
counts the more, the fewer such words chance puts there: it counts in a short text or beside
the address, and for nothing in a long text full of rare words.

A term whose certainty reaches ``MIN_POSTERIOR``, with at least ``MIN_BITS`` bits (of the
certainty), is a span (kind ``term``) wherever it stands outside a base span: it is
generalised to a placeholder, and removed where it is all but certain.

Defined cases: NULL and empty texts have no spans; texts of any length are read whole;
copies of a text count once in the corpus statistics; repeated rows get the same spans
each; a term that ties at a threshold is a span; an empty table gives no rows; other columns pass through (``n_chars``, where present, follows a
changed text), except that ``find_personal_data`` replaces columns that are named
like its own (``_base``, ``_spans``, ``_sure``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import in_own_names, read_table, written

KINDS = ("email", "ip", "card", "phone", "term")
#: The stated patterns.  Possessive forms and the look-behinds change no match:
#: they keep Java from recursing or rescanning on very long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: texts without such a part have no match of the kind
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
MIN_POSTERIOR = 0.8
MIN_BITS = 5.0
REMOVE_POSTERIOR = 0.99
MIN_TERM_CHARS = 3  # of terms in Latin letters
NEAR = 60  # characters on each side of a base span
SPAN = "struct<start:int,rank:int,kind:string,end:int,value:string>"


def _matches(text: Column, kind: str, pattern: Column) -> Column:
    """Leftmost non-overlapping matches as an array of ``SPAN``: the matches
    and the text between them give the positions."""
    def step(state, part):
        start = state["pos"] + F.length(part["gap"])
        end = start + F.length(F.coalesce(part["hit"], F.lit("")))
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
                        end.alias("end"), part["hit"].alias("value"))
        return F.struct(end.alias("pos"), F.when(part["hit"].isNull(), state["out"])
                        .otherwise(F.concat(state["out"], F.array(span))).alias("out"))

    parts = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
                         F.split(text, pattern, -1).alias("gap"))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.aggregate(parts, start, step, lambda s: s["out"])


def _part_in_range(part: Column) -> Column:
    digits = F.regexp_replace(part, "^0+", "")
    return (F.length(digits) <= 3) & (F.coalesce(digits.try_cast("int"), F.lit(0)) <= 255)


def _valid(span: Column, kind: str) -> Column:
    value = span["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _part_in_range)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of ``SPAN``, by start, then kind as listed."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")

    def checked(kind):
        spans = _matches(text, kind, F.lit(PATTERNS[kind]))
        return F.when(text.rlike(HINTS[kind]), F.filter(spans, lambda s: _valid(s, kind))).otherwise(none)

    return F.array_sort(F.concat(*map(checked, PATTERNS)))


def _terms(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")),
                    lambda t: (F.length(t) >= MIN_TERM_CHARS) | t.rlike(r"[\p{L}&&[^\p{IsLatin}]]"))


def _entity(span: Column) -> Column:
    value = F.when(span["kind"].isin("card", "phone"), F.regexp_replace(span["value"], "[^0-9]", "")) \
        .otherwise(F.lower(span["value"]))
    return F.xxhash64(span["kind"], value)


def _blanked(text: Column, base: Column) -> Column:
    """The text with blanks in place of each base span; all else keeps its place."""
    def step(state, s):
        piece = F.substring(text, state["pos"] + 1, F.greatest(s["start"] - state["pos"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], state["pos"]), F.lit(0)))
        return F.struct(F.greatest(state["pos"], s["end"]).alias("pos"), F.concat(state["out"], F.array(piece, blank)).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(base, start, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, s["pos"] + 1, F.greatest(F.length(text) - s["pos"], F.lit(0)))))


def _near(blanked: Column, base: Column) -> Column:
    """What stands within ``NEAR`` characters of a base span, without the words that the
    edge may cut."""
    def sides(s):
        left = F.substring(blanked, F.greatest(s["start"] - NEAR, F.lit(0)) + 1, F.least(s["start"], F.lit(NEAR)))
        right = F.substring(blanked, s["end"] + 1, F.lit(NEAR))
        return F.concat_ws(" ", F.when(s["start"] > NEAR, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left),
                           F.when(F.length(blanked) - s["end"] > NEAR, F.regexp_replace(right, r"\p{L}+$", "")).otherwise(right))

    return F.array_join(F.transform(base, sides), " ")


def _mark(*columns) -> Column:
    """With the count, names a set of rows (128 bits)."""
    return F.concat_ws(":", F.bit_xor(F.xxhash64(*columns)), F.bit_xor(F.xxhash64(F.lit(1), *columns)))


def disclosing_terms(texts: DataFrame, min_posterior: float = MIN_POSTERIOR,
                     min_bits: float = MIN_BITS) -> tuple[DataFrame, DataFrame] | None:
    """``(term, posterior, bits, certainty)`` of the terms above the thresholds (which
    decide on the certainty and its bits), and ``(text_key, term, own)`` of the texts that
    hold them (own: with an entity); None if no entity can be disclosed by so many bits.

    ``texts``: ``text_key, text, base``; ``base`` is read once.

    Entities found in the same texts form one class (``of``); so do terms that stand in
    the same texts with an entity, and near in the same of them (``at``): what is counted
    of one holds for all, so a list of addresses or of names is one row.
    """
    text = F.col("text")
    some = F.size("base") > 0
    blanked = _blanked(text, F.col("base"))
    seen = texts.select("text_key", F.when(some, F.array_distinct(F.transform("base", _entity))).alias("entities"),
                        F.when(some, _terms(blanked)).alias("terms"), F.when(some, _terms(_near(blanked, F.col("base")))).alias("close"))
    seen = written(seen, "pii-seen")
    total = seen.select("text_key").distinct().count()
    holders = written(seen.filter("entities IS NOT NULL").dropDuplicates(["text_key"]), "pii-holders")
    mentions = holders.select("text_key", F.size("terms").alias("all"), F.size("close").alias("some"), F.explode("entities").alias("entity"))
    # no posterior is above 1, which bounds the bits
    entities = mentions.groupBy("entity").agg(F.count("*").alias("df_entity"), F.sum("all").alias("all"), F.sum("some").alias("some"),
                                              _mark("text_key").alias("of")) \
        .filter(F.log2(F.lit(total) / F.col("df_entity")) >= min_bits)
    entities = written(entities, "pii-entities")
    top = entities.agg(F.max("df_entity")).first()[0]
    if top is None:
        return None

    def possible(df_entity):  # co is df_entity or df_term at most
        return F.least(df_entity, F.col("df_term")) >= min_posterior * F.col("df_term")

    words = texts.select("text_key", "text").dropDuplicates(["text_key"]).select(F.explode(_terms(text)).alias("term"))
    words = written(words.groupBy("term").agg(F.count("*").alias("df_term")), "pii-words")
    incidences = words.agg(F.sum("df_term")).first()[0] or 1
    alike = words.filter(possible(F.lit(top))).groupBy("df_term").agg(F.count("*").alias("n_terms"))  # at most top / min_posterior rows
    near = holders.select("text_key", F.explode(F.transform("terms", lambda t: F.struct(
        t.alias("term"), F.array_contains(F.col("close"), t).alias("near")))).alias("t")).select("text_key", "t.*")
    near = written(near.join(words.filter(possible(F.lit(top))), "term"), "pii-near")
    by_term = near.groupBy("term", "df_term").agg(_mark("text_key", "near").alias("at"), F.count("*").alias("own"))
    by_term = written(by_term, "pii-by-term")
    by_class = near.join(by_term.select("term", "at"), "term").select("text_key", "df_term", "near", "at").distinct()

    classes = mentions.join(entities.drop("all", "some"), "entity").select("text_key", "df_entity", "of").distinct()
    sizes = entities.select("df_entity", "of", "all", "some").distinct()
    pairs = by_class.join(classes, "text_key").filter(possible(F.col("df_entity"))).groupBy("df_term", "at", "df_entity", "of") \
        .agg(F.count("*").alias("co"), F.count_if("near").alias("co_near")).join(sizes, ["df_entity", "of"]).join(alike, "df_term")

    def by_chance(co, share):
        return F.exp(F.log("n_terms") + (F.col("df_term") - F.col(co)) * F.log("df_term") + F.col(co) * F.log(F.col(share) / F.lit(incidences)))

    chance = F.least(by_chance("co", "all"), F.when(F.col("co_near") > 0, by_chance("co_near", "some")))
    posterior = F.col("co") / F.col("df_term")
    certainty = posterior / (1 + chance)
    bits = lambda p: F.log2(p * F.lit(total) / F.col("df_entity"))
    strong = pairs.filter((certainty >= min_posterior) & (bits(certainty) >= min_bits)).groupBy("df_term", "at") \
        .agg(F.max(posterior).alias("posterior"), F.max(bits(posterior)).alias("bits"), F.max(certainty).alias("certainty"))
    strong = written(strong, "pii-strong")
    flagged = written(by_term.join(strong, ["df_term", "at"]), "pii-flagged")
    held = near.join(flagged.select("term"), "term").select("text_key", "term", F.lit(True).alias("own"))
    # the few terms that are in texts without an entity too
    elsewhere = written(flagged.filter("own < df_term").select("term"), "pii-elsewhere")
    if not elsewhere.isEmpty():
        rest = texts.filter(F.size("base") == 0).select("text_key", F.explode(_terms(text)).alias("term"))
        held = held.unionByName(rest.join(elsewhere, "term").distinct().withColumn("own", F.lit(False)))
    return flagged.drop("df_term", "at", "own"), held


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    r"""Spans of whole letter runs equal to a term, outside base spans."""
    quoted = F.array_join(F.transform(terms, lambda t: F.concat(F.lit(r"\Q"), t, F.lit(r"\E"))), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), quoted, F.lit(r")(?!\p{L})"))
    spans = _matches(text, "term", pattern)
    clear = F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.when(F.size(terms) > 0, clear).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_personal_data(docs: DataFrame, text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans`` (arrays of ``SPAN``; the second
    holds the first and the disclosing terms) and ``_sure`` (the spans' terms
    that are to be removed)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.withColumn("_text", text).withColumn("_key", F.md5(F.col("_text").cast("binary"))) \
        .withColumn("_base", base_spans(F.col("_text")))
    found = disclosing_terms(marked.select(F.col("_key").alias("text_key"), F.col("_text").alias("text"),
                                           F.col("_base").alias("base")), **thresholds)
    no_words = F.array().cast("array<string>")
    if found is None:
        return marked.withColumn("_spans", F.col("_base")).withColumn("_sure", no_words).drop("_text", "_key")
    flagged, held = found
    # a text's own words at most
    def by_text(own):
        terms = held.filter(F.col("own") == own).join(flagged, "term").groupBy(F.col("text_key").alias("_key")).agg(
            F.array_sort(F.collect_set("term")).alias("_terms"),
            F.array_sort(F.collect_set(F.when(F.col("certainty") >= REMOVE_POSTERIOR, F.col("term")))).alias("_sure"))
        return written(terms, "pii-by-text")

    # apart, as nearly all terms are in texts with an entity: the others need not move for them
    out = marked.filter(F.size("_base") > 0).join(by_text(True), "_key", "left").unionByName(
        marked.filter(F.size("_base") == 0).withColumn("_base", F.array().cast(f"array<{SPAN}>")).join(by_text(False), "_key", "left"))
    out = out.withColumn("_terms", F.coalesce("_terms", no_words)).withColumn("_sure", F.coalesce("_sure", no_words))
    spans = F.array_sort(F.concat("_base", _term_spans(F.col("_text"), F.col("_terms"), F.col("_base"))))
    return out.withColumn("_spans", spans).drop("_text", "_key", "_terms")


def sanitise(docs: DataFrame, text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with every span replaced: ``<EMAIL>``, ``<IP>``, ``<CARD>``,
    ``<PHONE>``, ``<TERM>``; all but certain terms go without a trace.  Spans that
    overlap are replaced together, to the last end, by the one that starts first."""
    columns = {"text_col": text_col} | ({"chars_col": "n_chars"} if "n_chars" in docs.columns else {})
    return in_own_names(docs, lambda inner, **names: _sanitised(inner, **names, **thresholds), **columns)


def _sanitised(docs: DataFrame, text_col: str, chars_col: str | None = None, **thresholds) -> DataFrame:
    found = find_personal_data(docs, text_col, **thresholds)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def step(state, s):
        shown = F.when(F.array_contains(F.col("_sure"), F.lower(s["value"])) & (s["kind"] == "term"), F.lit("")) \
            .otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        piece = F.concat(F.substring(text, state["pos"] + 1, s["start"] - state["pos"]), shown)
        covered = s["start"] < state["pos"]
        return F.struct(F.greatest(state["pos"], s["end"]).alias("pos"),
                        F.when(covered, state["out"]).otherwise(F.concat(state["out"], F.array(piece))).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    cleaned = F.aggregate("_spans", start, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, s["pos"] + 1, F.greatest(F.length(text) - s["pos"], F.lit(0)))))
    changed = F.size("_spans") > 0
    out = found.withColumn("_clean", F.when(changed, cleaned).otherwise(F.col(text_col).cast("string")))
    if chars_col:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(changed, F.length("_clean").cast(kind)).otherwise(F.col(chars_col)))
    return out.withColumn(text_col, F.col("_clean"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(docs)

    def count(kind):
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, PATTERNS), F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
                        _joined(F.col("_spans")).alias("spans"))
