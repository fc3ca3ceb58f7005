"""Archives: round trips, revisits, and what a reader must refuse."""

import hashlib
import io
import struct
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from conftest import SF01
from shelfwise.llm import warc_zstd as wz
from shelfwise.llm.common import scratch_path


def brute(rows):
    groups = defaultdict(list)
    for i, html in rows:
        groups[html or ""].append(-1 if i is None else i)
    out = Counter()
    for i, html in rows:
        data = (html or "").encode()
        first = max(groups[html or ""])
        again = len(data) >= 1000 and (-1 if i is None else i) != first
        out[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    return out


def result(df):
    return Counter(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "html").collect()]
    assert result(wz.op13_warc_zstd(spark, SF01)) == brute(rows)


def test_round_trip_of_hard_rows(spark):
    long, short = "P*M\x18\0\0\0\0" * 200 + "€", "x" * 999
    urls = [None, "", "http://a/\r\nX: y", "http://a/ü?%41=%", " http://b ", "http://c/", "日本"]
    rows = [(k, urls[k % 7], long) for k in range(40)] + [(40 + k, "http://d", short) for k in range(9)]
    rows += [(39, "http://e", long), (None, None, long), (None, "http://f", "y" * 1000), (None, "http://f", "y" * 1000), (60, "http://g", None),
             (61, "http://g", ""), (62, "http://h", "\r\n\r\nWARC/1.1\r\n\r\n"), (63, "http://i", "z" * 3_000_000), (-5, "http://j", "é" * 500), (-9, "http://j", "é" * 500)]
    df = spark.createDataFrame([(*r, "w") for r in rows], "page_id long, url string, html string, revisit string")
    path = scratch_path(spark, "warc-test")
    wz.write_archives(df, path, archive_bytes=200_000)
    back = wz.read_archives(spark, path)
    assert back.select("archive").distinct().count() > 3
    assert result(back) == brute([(i, h) for i, _, h in rows])
    assert Counter((r["page_id"], r["url"]) for r in back.collect()) == Counter((i, u) for i, u, _ in rows)
    whole = {(r["page_id"], bytes(r["payload"])) for r in back.filter("record_type = 'response'").collect()}
    assert whole <= {(i, (h or "").encode()) for i, _, h in rows} and (63, b"z" * 3_000_000) in whole
    assert back.filter("record_type = 'revisit' AND payload IS NOT NULL").isEmpty()


def test_empty_table(spark):
    path = scratch_path(spark, "warc-empty")
    wz.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert wz.read_archives(spark, path).isEmpty()


def test_files_are_plain_archives(spark):
    """Any zstandard reader sees the records behind the dictionary of the first frame."""
    path = scratch_path(spark, "warc-plain")
    wz.write_archives(spark.read.parquet(f"{SF01}/pages.parquet"), path)
    content = bytes(spark.read.format("binaryFile").load(path).filter("length > 0").head()["content"])
    magic, size = struct.unpack_from("<II", content)
    assert magic == 0x184D2A5D
    words = zstandard.ZstdCompressionDict(zstandard.decompress(content[8:8 + size], max_output_size=1 << 20))
    stream = zstandard.ZstdDecompressor(dict_data=words).stream_reader(io.BytesIO(content[8 + size:]), read_across_frames=True)
    text = stream.read()
    assert text.count(b"WARC/1.1\r\nWARC-Type: response") == 250 and text.endswith(b"\r\n\r\n")
    assert len(content) < 0.5 * len(text)


def archive(tmp_path, name, *frames):
    (tmp_path / name).write_bytes(b"".join(frames))


def record(page_id, payload=b"hello", **changes):
    out = wz.encode_record(page_id, "http://a/", payload)
    for old, new in changes.values():
        assert old in out
        out = out.replace(old, new)
    return zstandard.ZstdCompressor().compress(out)


def test_problems_are_reported(spark, tmp_path):
    good = record(1)
    unsized = zstandard.ZstdCompressor(write_content_size=False).compress(wz.encode_record(2, None, b"unsized"))
    bad = {
        "version": record(3, a=(b"WARC/1.1", b"WARK/1.1")), "header": record(3, a=(b"WARC-Date: 2000-01-01T00:00:00Z\r\n", b"")),
        "twice": record(3, a=(b"Content-Type: application", b"WARC-Date: x\r\nContent-Type: application")),
        "length": record(3, a=(b"Content-Length: 83", b"Content-Length: 82")), "number": record(3, a=(b"Content-Length: 83", b"Content-Length: +83")),
        "block": record(3, a=(b"hello", b"hallo")), "http": record(3, a=(b"HTTP/1.1", b"HTTQ/1.1")),
        "colon": record(3, a=(b"WARC-Date:", b"WARC-Date ")), "type": record(3, a=(b"Type: response", b"Type: conversion")),
        "checksum": zstandard.ZstdCompressor(write_checksum=True).compress(wz.encode_record(3, None, b"x" * 50))[:-1] + b"\0",
    }
    skip = struct.pack("<II", 0x184D2A53, 3) + b"abc"
    for name, frame in bad.items():
        archive(tmp_path, name, good, skip, frame, skip, unsized)
    archive(tmp_path, "cut", good, unsized[:-3])
    archive(tmp_path, "junk", good, b"not a frame at all")
    back = wz.read_archives(spark, str(tmp_path), problems="report").withColumn("name", F.element_at(F.split("archive", "/"), -1))
    for name in bad:
        found = {r["page_id"]: r for r in back.filter(F.col("name") == name).collect()}
        assert set(found) == {1, 2, None}, name
        assert found[None]["problem"] and found[None]["offset"] == len(good) + len(skip), name
        assert found[1]["problem"] is None and bytes(found[2]["payload"]) == b"unsized"
    for name in ("cut", "junk"):
        found = back.filter(F.col("name") == name).collect()
        assert sorted((r["page_id"] is None, r["problem"] is None) for r in found) == [(False, True), (True, False)]
    for name in ("length", "junk"):
        with pytest.raises(Exception, match="byte"):
            wz.read_archives(spark, str(tmp_path / name)).collect()


def test_rows_per_hot_payload_are_spread(spark):
    """A payload that most rows share is looked up, not joined in one task."""
    df = spark.range(6000).selectExpr("id AS page_id", "CAST(null AS string) AS url", "CASE WHEN id % 3 > 0 THEN repeat('h', 1500) ELSE repeat(CAST(id AS string), 400) END AS html")
    marked = wz.with_revisits(df.selectExpr("page_id", "url", "CAST(html AS binary) AS payload"))
    assert marked.filter("revisit").count() == 3999
    assert {tuple(r) for r in marked.filter("revisit").select("refers_to").distinct().collect()} == {(5999,)}
    assert "BroadcastHashJoin" in marked._jdf.queryExecution().toString()
