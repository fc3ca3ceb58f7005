"""Text counts and the cross-document rule against brute force and the SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from conftest import SF01, SF001
from shelfwise.llm import line_quality as lq

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
           "n_removed_lines", "n_left_words"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    return " ".join(WORD.findall(line)).lower()


def brute(rows, limit=50):
    """rows: (doc_id, host, text)."""
    held = defaultdict(set)
    for doc, host, text in rows:
        for line in {normal(x) for x in (text or "").split("\n")} - {""}:
            held[host, line].add(doc)
    shared = {k for k, v in held.items() if len(v) > limit}
    out = []
    for doc, host, text in rows:
        text = text or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        five = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        n = Counter(five)
        inside = {i + k for i, x in enumerate(five) if n[x] > 1 for k in range(5)}
        failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
        gone = [x for x in lines if (host, normal(x)) in shared]
        left = len(w) - sum(len(WORD.findall(x)) for x in gone)
        out.append((doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
                    failed, not failed and not (gone and 100 * left < 30 * len(w)), len(gone), left))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_query_equals_brute_force_and_sql(spark, sf_dir):
    have = got(lq.op5_line_quality(spark, sf_dir))
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert have == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    res = con.execute(lq.ORACLE_SQL)
    assert [d[0] for d in res.description] == COLUMNS
    assert sorted(res.fetchall(), key=repr) == have


def test_cases(spark):
    foot = "Shared  FOOTER line of this host"
    rows = [(i, "h" if i % 3 else None, f"own words number {i} a b c d e f g h\n{foot}\n\n \t\nlast {i}") for i in range(60)]
    rows += [(100, "h", foot.lower()), (101, "h", foot + "\nx"), (102, "h", None), (103, "h", ""), (104, None, " \n\t\x0b"),
             (105, "h", "a b c d e " * 3000), (106, "h", "a b c d e a b c d e f"), (107, "h", "x\nx\n x\ny\ny z"),
             (108, "z", "é😀 #*$%&|<> ñ\r\nq")] + [(5, rows[5][1], rows[5][2])] * 3
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, source string, text string, kept string").drop("kept")
    for limit in (50, 19, 10):
        want = brute(rows, limit)
        assert got(lq.judge(df, max_documents=limit)) == want
    assert any(r[8] and r[7] for r in want)
    long = spark.createDataFrame([(i, "h", "one two three four five six seven eight nine ten eleven " + str(i % 2) + "\n" + " ".join(
        f"c{j}" for j in range(40))) for i in range(30)] + [(50 + i, "h", " ".join(f"u{i}x{j}" for j in range(30))) for i in range(20)]
        + [(90 + i, "h", " ".join(f"c{j}" for j in range(40)) + "\nonly tail " + "t" * i) for i in range(1, 12)],
        "doc_id long, source string, text string")
    verdict = {r.doc_id: r.kept for r in lq.judge(long, max_documents=20).collect()}
    assert verdict[55] and not verdict[95]
    cleaned = lq.remove_boilerplate(long, max_documents=20)
    assert cleaned.columns == long.columns and not any("c39" in r.text for r in cleaned.collect())
    assert lq.judge(df.limit(0)).count() == 0


def test_verdict_of_a_line_does_not_depend_on_the_size_of_its_host(spark, monkeypatch):
    monkeypatch.setattr(lq, "HOT_SHARE", 30)  # both ways of marking
    def frame(n):
        return spark.range(n).selectExpr(
            "id AS doc_id", "'h' AS source",
            "concat(if(id < 60, 'in sixty of them\\n', ''), if(id < 50, 'in fifty of them\\n', ''), "
            "array_join(transform(sequence(1, 15), j -> concat('w', id, 'x', j)), ' ')) AS text")

    seen = [{r.doc_id: r.n_removed_lines for r in lq.judge(frame(n)).filter("n_removed_lines > 0").collect()} for n in (500, 20_000)]
    assert seen[0] == seen[1] == dict.fromkeys(range(60), 1)


def test_copies_and_repeated_rows(spark):
    """Copies of a text are documents; rows of one id are one."""
    text = "\n".join(" ".join(f"w{k}x{j}" for j in range(8)) for k in range(4))
    copies = [(k, "h", text) for k in range(51)] + [(100, "g", text)] * 60 + [(None, "f", text)] * 60
    df = spark.createDataFrame(copies, "doc_id long, source string, text string")
    assert got(lq.judge(df)) == brute(copies)
    assert {(r.doc_id is not None and r.doc_id < 51): r.kept for r in lq.judge(df).collect()} == {True: False, False: True}
    assert lq.remove_boilerplate(df).count() == 120
