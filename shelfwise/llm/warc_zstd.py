"""Zstandard web archives (.warc.zst): written as one frame a record behind a
dictionary frame, read back with every header, length and digest checked.

*Layout.*  An archive begins with a skippable frame of magic ``0x184D2A5D`` that holds
the dictionary (plain or itself compressed); after it each record is one frame,
compressed with the dictionary.  Other skippable frames are passed over, and an archive
without a dictionary frame is read without one.

*Writing.*  Records are dealt in equal number to as many archives as their payloads fill
``ARCHIVE_BYTES`` each, whatever their ids, so no archive outgrows the others.  Each
archive trains its own dictionary on its first ``DICTIONARY_SAMPLE`` bytes of records.
Files are written by Spark's text writer, whose commit survives lost executors, with the
frames as rows and an *empty skippable frame* as the line separator; so the files are
whole archives for any reader and on any file system that Spark can write to.

*Revisits.*  Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one
with the largest page id is a ``response``, the others are ``revisit`` records, which
keep the HTTP header with its length but no payload.  Equal payloads are found by
SHA-1 and length; groups with more than a thousandth of the rows (fewer than a thousand
of them) are looked up by broadcast, all others by a join, so no payload gathers in a task.

*Reading.*  Frames are cut at their own block headers, decompressed one at a time and
never beyond ``MOST_BYTES``; version line, required headers, content length, closing
blank lines, block and payload digests, the HTTP header and its length are checked.  ``problems="raise"``
(default) fails on the first bad record; ``"report"`` returns it with a ``problem``, and
after a frame that cannot be cut the rest of that archive as one problem row.

Defined cases: a NULL payload is empty; a NULL url has no target header; urls with
control characters, outer spaces or other than ASCII letters are percent-encoded and
read back equal; a NULL page id sorts below all others (a group of NULL ids only is all
responses); rows that repeat a page id and payload are all responses or all revisits,
and share a record id; payloads of any length are written whole; an empty table gives
an archive folder without records, which reads as no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import read_table, scratch_path, written

DICTIONARY_MAGIC, SKIPPABLE, FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
#: an empty skippable frame; its bytes are text, so that it can separate lines
SEPARATOR = struct.pack("<II", SKIPPABLE, 0)
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES, DICTIONARY_SAMPLE = 64 << 10, 2 << 20
#: no record may be longer when decompressed
MOST_BYTES = 1 << 31
DATE = "2000-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
RECORD_ID = "urn:page:"


# --- records ------------------------------------------------------------------

def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _target(url: str) -> list[str]:
    plain = url.isascii() and url.isprintable() and url == url.strip() and url
    return [f"WARC-Target-URI: {url}"] if plain else [f"WARC-Target-URI: {urllib.parse.quote(url, safe='/:?#&=')}", "X-Target-Encoding: percent"]


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False,
                  date: str = DATE) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
            f"WARC-Date: {date}", *(_target(url) if url is not None else []), "Content-Type: application/http; msgtype=response",
            f"WARC-Block-Digest: {_digest(block)}", f"WARC-Payload-Digest: {_digest(payload)}"]
    if revisit:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{RECORD_ID}{'' if refers_to is None else refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed header line {line[:80]!r}")
        if name.lower() in out:
            raise ValueError(f"header {name} occurs twice")
        out[name.lower()] = value.strip()
    return out


def _length(headers: dict[str, str]) -> int:
    value = headers["content-length"]
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"Content-Length is {value!r}")
    return int(value)


def _page(value: str) -> int | None:
    if not (value.startswith(f"<{RECORD_ID}") and value.endswith(">")):
        raise ValueError(f"record id is {value!r}")
    number = value[len(RECORD_ID) + 1:-1]
    return int(number) if number else None


def decode_record(record: bytes) -> dict:
    """Fields of one record; ``ValueError`` says what is wrong with a bad one."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1") or not blank:
        raise ValueError(f"no WARC header, begins with {record[:20]!r}")
    headers = _headers(lines)
    missing = [h for h in REQUIRED if h.lower() not in headers]
    if missing:
        raise ValueError(f"missing {', '.join(missing)}")
    length = _length(headers)
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {length}, but {len(rest) - 4} bytes before the end")
    block = rest[:length]
    if headers.get("warc-block-digest", said := _digest(block)) != said:
        raise ValueError("block digest differs")
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"record type {kind}")
    http, blank, payload = block.partition(b"\r\n\r\n")
    status, *lines = http.split(b"\r\n")
    if not status.startswith(b"HTTP/") or not blank:
        raise ValueError("no HTTP header in the block")
    inner = _headers(lines)
    if "content-length" not in inner:
        raise ValueError("no HTTP Content-Length")
    size, digest = _length(inner), headers.get("warc-payload-digest")
    refers_to = None
    if kind == "revisit":
        if payload or digest is None or "warc-refers-to" not in headers:
            raise ValueError("a revisit has a payload, or lacks its digest or the record it refers to")
        refers_to = _page(headers["warc-refers-to"])
    else:
        if len(payload) != size:
            raise ValueError(f"HTTP Content-Length {size}, but the payload has {len(payload)} bytes")
        if digest is None:
            digest = _digest(payload)
        elif digest != _digest(payload):
            raise ValueError("payload digest differs")
    if not digest.startswith("sha1:"):
        raise ValueError(f"payload digest {digest}")
    url = headers.get("warc-target-uri")
    if url is not None and headers.get("x-target-encoding") == "percent":
        url = urllib.parse.unquote(url, errors="strict")
    return {"page_id": _page(headers["warc-record-id"]), "record_type": kind, "refers_to": refers_to, "url": url, "date": headers["warc-date"],
            "payload_bytes": size, "payload_digest": base64.b32decode(digest[5:]).hex(), "payload": None if kind == "revisit" else payload}


# --- frames -------------------------------------------------------------------

def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, by its block headers."""
    import zstandard

    if len(data) - at < 8:
        raise ValueError("truncated frame")
    magic, size = struct.unpack_from("<II", data, at)
    if magic & ~0xF == SKIPPABLE:
        end = at + 8 + size
    elif magic == FRAME_MAGIC:
        end = at + zstandard.frame_header_size(data[at:at + 18])
        last = 0
        while not last:
            if end + 3 > len(data):
                raise ValueError("truncated frame")
            block = int.from_bytes(data[end:end + 3], "little")
            last, kind = block & 1, block >> 1 & 3
            if kind == 3:
                raise ValueError("reserved block type")
            end += 3 + (1 if kind == 1 else block >> 3)
        end += 4 * (data[at + 4] >> 2 & 1)  # checksum
    else:
        raise ValueError(f"no frame at byte {at}")
    if end > len(data):
        raise ValueError("truncated frame")
    return end


def archive_records(content: bytes, most: int = MOST_BYTES):
    """``offset, record`` for each record frame; a ``ValueError`` in place of a record that
    cannot be decompressed, and last one for a rest that cannot be cut into frames."""
    import zstandard

    data, at, plain = memoryview(content), 0, zstandard.ZstdDecompressor()
    reader = plain
    while at < len(data):
        try:
            end = frame_end(data, at)
        except (ValueError, zstandard.ZstdError) as bad:
            yield at, ValueError(str(bad))
            return
        frame, magic = data[at:end], struct.unpack_from("<I", data, at)[0]
        if magic == DICTIONARY_MAGIC and at == 0:
            words = bytes(frame[8:])
            if words[:4] == struct.pack("<I", FRAME_MAGIC):
                words = plain.decompressobj().decompress(words)
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
        elif magic == FRAME_MAGIC:
            try:
                size = zstandard.frame_content_size(frame)
                if size > most:
                    raise ValueError(f"a record of {size} bytes")
                if size >= 0:
                    yield at, reader.decompress(frame)
                else:  # a writer that did not know the size
                    with reader.stream_reader(frame) as stream:
                        record = stream.read(most + 1)
                    if len(record) > most:
                        raise ValueError(f"a record of more than {most} bytes")
                    yield at, record
            except (ValueError, zstandard.ZstdError) as bad:
                yield at, ValueError(str(bad))
        at = end


def _dictionary_frame(samples: list[bytes], size: int):
    """The leading frame and the dictionary; (b"", None) where too little is there to learn from."""
    import zstandard

    try:
        learned = zstandard.train_dictionary(size, samples) if len(samples) > 7 else None
    except zstandard.ZstdError:
        learned = None
    if learned is None:
        return b"", None
    words = zstandard.ZstdCompressor().compress(learned.as_bytes())
    return struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words, learned


# --- Spark --------------------------------------------------------------------

def _rows(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _encoded(row: dict) -> bytes:
    return encode_record(row["page_id"], row["url"], row["payload"], row["refers_to"], row["revisit"])


def _by_size(items, most: int):
    """Lists of ``items`` that reach ``most`` bytes (the last one: what is left)."""
    held, size = [], 0
    for item in items:
        held.append(item)
        size += len(item)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def with_revisits(records: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``records`` (``page_id, url, payload``) with ``revisit`` and ``refers_to``."""
    keyed = records.withColumns({"n_bytes": F.octet_length("payload"), "sha1": F.sha1("payload")})
    keyed = keyed.withColumn("same", F.when(F.col("n_bytes") >= least_bytes, F.concat_ws(":", "sha1", "n_bytes")))
    groups = keyed.filter("same IS NOT NULL").groupBy("same").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
    groups = written(groups.filter("n > 1"), "warc-groups", narrow=True)
    hot = f"n > {records.count() // 1000}"
    frequent = groups.filter(hot).select("same", F.col("first").alias("hot_first"))  # under 1000 rows
    rare = groups.filter(f"NOT {hot}").select("same", "first")
    found = keyed.join(F.broadcast(frequent), "same", "left")
    # what cannot be in a rare group is spread by a key of its own, which no group has
    alone = F.col("same").isNull() | F.col("hot_first").isNotNull()
    spread = F.concat(F.lit("-"), F.xxhash64("page_id", "url"))
    found = found.withColumn("same", F.when(alone, spread).otherwise(F.col("same"))).join(rare, "same", "left")
    first = F.coalesce("hot_first", "first")
    revisit = first.isNotNull() & ~F.col("page_id").eqNullSafe(first)
    return found.select("page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, first).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for each row of ``pages`` to archives in the new folder ``path``."""
    records = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                           F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    total = records.agg(F.sum(F.octet_length("payload"))).head()[0] or 0
    dealt = with_revisits(records, least_bytes).repartition(max(1, -(-total // archive_bytes)))

    def frames(batches):
        import zstandard

        writer = None
        for held in _by_size(map(_encoded, _rows(batches)), DICTIONARY_SAMPLE):
            lead = b""
            if writer is None:
                lead, words = _dictionary_frame(held, DICTIONARY_BYTES)
                writer = zstandard.ZstdCompressor(dict_data=words, write_checksum=True, write_content_size=True)
            found = [writer.compress(r) for r in held]
            yield pa.RecordBatch.from_pydict({"frame": pa.array([lead, *found] if lead else found, pa.binary())})

    out = dealt.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
    out.write.option("lineSep", SEPARATOR.decode()).text(path)


def read_archives(spark: SparkSession, path: str, problems: str = "raise", with_payload: bool = True) -> DataFrame:
    """``archive, offset, page_id, record_type, refers_to, url, date, payload_bytes, payload_digest, payload, problem``
    for each record of the archives under ``path``."""
    if problems not in ("raise", "report"):
        raise ValueError(f"problems is {problems!r}, not 'raise' or 'report'")
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("payload", pa.binary()), ("problem", pa.string())])

    def read(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for offset, record in archive_records(content.as_buffer()):
                    row = {"archive": archive, "offset": offset}
                    try:
                        if isinstance(record, ValueError):
                            raise record
                        row |= decode_record(record)
                    except ValueError as bad:
                        if problems == "raise":
                            raise ValueError(f"{archive}, byte {offset}: {bad}") from bad
                        row["problem"] = str(bad)
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    size += 200 + len(row.get("payload") or b"")
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter("length > 0")
    return files.select("path", "content").mapInArrow(
        read, "archive string, offset long, page_id long, record_type string, refers_to long, url string, date string, "
              "payload_bytes long, payload_digest string, payload binary, problem string")


def op13_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH r AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS first FROM r WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM coalesce(first, page_id) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM coalesce(first, page_id) THEN first END AS refers_to
FROM r LEFT JOIN m USING (payload_digest)
"""
