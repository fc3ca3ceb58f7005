"""Base spans against Python's re, disclosing terms against brute-force counts."""

import hashlib
import math
import re
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from shelfwise.llm import pii_disclosure as pd_

sys.set_int_max_str_digits(0)
KINDS = ("email", "ip", "card", "phone", "term")
RAW = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+",
       "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def ok(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in v.split(".")),
            "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def base(text):
    out = [(m.start(), KINDS.index(k), k, m.end(), m.group()) for k, p in RAW.items()
           for m in re.finditer(p, text or "") if ok(k, m.group())]
    return sorted(out)


def shown(spans):
    return ",".join(f"{s[2]}:{s[0]}:{s[3]}" for s in spans)


HARD = [None, "", "a@b.c_d@e.f..g@h", "x@y", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.255 1.2.3", "4111 1111 1111 1111",
        "4111-1111 1111-1111, 4111111111111112 0000 0000 0000", "+1 (017) 555-7713 +49.123.4567 +1+2 +123456789012345678",
        "é😀 m@x.org 😀 +44 20 7946 0958", "1" * 30_000 + ".1.1.1", "a" * 30_000 + "@b" + ".c" * 12_000,
        "mail.a.b@c-d.e-f, 10.0.0.1@host.example", "4 " * 9_000]


def test_base_spans(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    hard = spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    docs = docs.unionByName(hard)
    for r in docs.withColumn("b", pd_.base_spans(F.col("text"))).collect():
        assert [tuple(s) for s in r.b] == base(r.text), r.doc_id


def test_query(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in pd_.op10_pii_disclosure(spark, SF001).collect():
        want = base(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in want) for k in KINDS[:4]]
        assert r.base_sha256 == hashlib.sha256(shown(want).encode()).hexdigest()
        assert {*filter(None, shown(want).split(","))} <= {*r.spans.split(",")}


@pytest.fixture(scope="module")
def planted(spark):
    rows = []
    for i in range(12):  # the nickname stands near one address only, and twice alone
        rows.append((i, f"note{i} from Zanzibarius <z.b@corp.example> about number {i} words"))
    rows.append((12, "Zanzibarius was here"))
    for i in range(13, 140):
        rows.append((i, f"about number words here {'from' if i % 2 else 'by'} item {i}"))
    rows += [(7, rows[7][1])] * 3 + [(None, None), (200, "")]
    return spark.createDataFrame([(d, t, "s", -1) for d, t in rows], "doc_id long, text string, _base string, n_chars long"), rows


def marked(df):
    text = F.coalesce("text", F.lit(""))
    return df.select(F.xxhash64(text).alias("text_key"), text.alias("text")).withColumn("base", pd_.base_spans(F.col("text")))


def words_of(text):
    return {w for w in re.split(r"[\W\d_]+", text.lower()) if len(w) >= 3 or (w and not w.isascii() and "\u2e80" <= w[0])}


def shipped_rule(texts, min_posterior=0.8, min_bits=5.0, near=60):
    """{term: (posterior, bits, certainty)} by loops over all texts, terms and entities."""
    texts = {t or "" for t in texts}
    df = Counter(w for t in texts for w in words_of(t))
    of_df, incidences = Counter(df.values()), sum(df.values())
    held = {}
    for t in texts:
        spans = base(t)
        if spans:
            blank = list(t)
            for a, _, _, b, _ in spans:
                blank[a:b] = " " * (b - a)
            blank, close = "".join(blank), set()
            for a, _, _, b, _ in spans:
                left, right = blank[max(a - near, 0):a], blank[b:b + near]
                left = re.sub(r"^[^\W\d_]+", "", left) if a > near else left
                right = re.sub(r"[^\W\d_]+$", "", right) if len(t) - b > near else right
                close |= words_of(left) | words_of(right)
            held[t] = ({(k, re.sub("[^0-9]", "", v) if k in ("card", "phone") else v.lower()) for _, _, k, _, v in spans}, words_of(blank), close)
    out = {}
    for e in set().union(*(x[0] for x in held.values())):
        mine = [x for x in held.values() if e in x[0]]
        for w in set().union(*(x[1] for x in mine)):
            n, co, co_near = df[w], sum(w in x[1] for x in mine), sum(w in x[2] for x in mine)
            if co / n < min_posterior:
                continue
            chance = of_df[n] * n ** (n - co) * (sum(len(x[1]) for x in mine) / incidences) ** co
            if co_near:
                near_log = math.log(of_df[n]) + (n - co_near) * math.log(n) + co_near * math.log(sum(len(x[2]) for x in mine) / incidences)
                chance = min(chance, math.exp(min(near_log, 700)))
            certainty = co / n / (1 + chance)
            bits = [math.log2(p * len(texts) / len(mine)) for p in (co / n, certainty)]
            if certainty >= min_posterior and bits[1] >= min_bits:
                out[w] = tuple(map(max, zip(out.get(w, (0, 0, 0)), (co / n, bits[0], certainty))))
    return out


def flagged_of(df, **thresholds):
    found = pd_.disclosing_terms(marked(df), **thresholds)
    return {r.term: (r.posterior, r.bits, r.certainty) for r in found[0].collect()} if found else {}


def same(got, want):
    assert got.keys() == want.keys()
    assert all(got[t] == pytest.approx(want[t]) for t in want)


def test_disclosing_terms_equal_brute_force(spark, planted):
    df, rows = planted
    want = shipped_rule([t for _, t in rows], min_bits=3.0)
    same(flagged_of(df, min_bits=3.0), want)
    assert "zanzibarius" in want


@pytest.mark.parametrize("sf_dir, posterior", [(SF001, 0.8), (SF01, 0.8), (SF01, 0.2)])
def test_given_tables_equal_brute_force(spark, sf_dir, posterior):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = shipped_rule([r.text for r in docs.collect()], min_posterior=posterior)
    same(flagged_of(docs, min_posterior=posterior), want)
    assert want or posterior > 0.5


def test_rare_words_count_by_how_many_chance_puts_there(spark):
    """A name in one text is a span in a short text and beside the address, and no span
    among a hundred words that are as rare."""
    rare = lambda i: " ".join(f"{chr(97 + k // 26)}{chr(97 + k % 26)}{'abcdefgh'[i]}zq" for k in range(100))
    common = "these common words stand in very many of the texts"
    texts = ["Quillington q@corp.example", f"Oberwaldt {rare(0)} x.y@corp.example", f"{common} {rare(1)} {common} Halvorsen h@corp.example",
             f"Marchetti m@corp.example {common} and {common} again {rare(2)}"] + [f"{common} {i}" for i in range(2000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = flagged_of(df)
    same(got, shipped_rule(texts))
    assert {"quillington", "marchetti", "halvorsen"} <= got.keys() and "oberwaldt" not in got
    assert not any(w.endswith("zq") and w not in rare(0) + rare(1) + rare(2) for w in got)


def test_share_of_words_replaced(spark):
    """Beside the base spans, few words of a text go."""
    found = pd_.find_personal_data(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text"))
    shares = [sum(s.kind == "term" for s in r._spans) / len(r.text.split()) for r in found.filter("size(_base) > 0").collect()]
    assert max(shares) <= 0.25 and sum(shares) / len(shares) < 0.02


def test_sanitise(spark, planted):
    df, rows = planted
    out = pd_.sanitise(df, min_bits=3.0).collect()
    assert len(out) == len(rows) and list(out[0].asDict()) == ["doc_id", "text", "_base", "n_chars"]
    assert {r._base for r in out} == {"s"}
    by = {r.doc_id: r for r in out}
    assert "z.b@corp" not in by[3].text and "<EMAIL>" in by[3].text and "Zanzi" not in by[3].text
    assert by[12].text == "<TERM> was here" and by[12].n_chars == 15
    assert by[20].text == rows[20][1] and by[20].n_chars == -1
    assert by[None].text is None and by[200].text == ""
    found = pd_.find_personal_data(df.drop("_base"), min_bits=3.0).filter("doc_id = 12").first()
    assert shown([tuple(s) for s in found._spans]) == "term:0:11"
    assert pd_.sanitise(df.drop("_base").limit(0)).count() == 0


def test_overlapping_spans_are_replaced_once(spark):
    df = spark.createDataFrame([(1, "to 10.0.0.1@host.example or a@1.2.3.4 end")], "doc_id long, text string")
    assert pd_.sanitise(df).first().text == "to <EMAIL> or <EMAIL> end"


def test_partly_overlapping_spans_leave_no_tail(spark):
    texts = ["call +1 555 123 4567 99bob@mail.com", "pay 4111 1111 1111 1111@mail.com now", "a@1.2.3.4.example +1 555 123 4567 9@x.org +2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.text for r in pd_.sanitise(df).collect()} == {0: "call <PHONE>", 1: "pay <CARD> now", 2: "<EMAIL> <PHONE> +2"}


def test_terms_far_from_the_entity_and_short_names_count(spark):
    far = " common words" * 30
    rows = [f"Quillington{far} {i} q@corp.example" if i % 5 else f"Quillington q@corp.example {far} {i}" for i in range(10)]
    rows += [f"王伟{far} {i} wang@corp.example" for i in range(10)]
    rows += [f"common words number {i}" for i in range(400)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    flagged, held = pd_.disclosing_terms(marked(df))
    assert {(r.term, r.posterior) for r in flagged.collect()} == {("quillington", 1.0), ("王伟", 1.0)}
    same(flagged_of(df), shipped_rule(rows))
    assert held.count() == 20 and not any("uilli" in r.text or "王" in r.text for r in pd_.sanitise(df).collect())


def test_a_name_beside_the_only_mention_of_an_address(spark):
    rows = [(0, "Quillington writes from quill@corp.example about common words"), (1, "Oberwaldt 10.1.2.3 common words about"),
            (2, "Oberwaldt 10.1.2.3 again common words")] + [(i, f"about common words again writes from number {i}") for i in range(3, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = flagged_of(df)
    same(got, shipped_rule([t for _, t in rows]))
    assert got.keys() == {"quillington", "oberwaldt"} and all(c > 0.98 for _, _, c in got.values())
    by = {r.doc_id: r.text for r in pd_.sanitise(df).collect()}
    assert by[0] in ("<TERM> writes from <EMAIL> about common words", " writes from <EMAIL> about common words")
    assert by[2] in ("<TERM> <IP> again common words", " <IP> again common words")
    assert all(by[i] == t for i, t in rows[3:])
