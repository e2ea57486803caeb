"""Legacy ARC archives to WARC (operator 9).

ARC files (versions 1 and 2) are read by their own header definition and the
declared record lengths; every record gets the WARC identifiers, timestamps,
types and digests that a crawl would have written today.  WARC files go
through Spark's text sink (a record per row, the record end mark as line
separator), so they may live in any store that Spark writes to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize, pick, text_or_empty
from ledgerlens.llm._words import parts

# The URL-record definitions of the two ARC versions.
ARC_FIELDS = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_END = "\r\n\r\n"
#: Records in one WARC file, and pages in one ARC archive, at most: what a task holds at once.
RECORDS = 1000
#: Payload bytes in one WARC file, or in one ARC archive, at most (a longer payload has one of its own).
FILE_BYTES = 256 << 20

RECORD_SCHEMA = ("archive string, arc_version int, url string, ip string, arc_date string, content_type string, "
                 "http string, payload binary, error string")


# ---------------------------------------------------------------- writing ARC

def _token(text: str | None) -> str:
    """A header field: percent-encoded white space and controls, '-' if empty."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text or "") or "-"


def _arc_date(number: int | None) -> str:
    """A 14-digit timestamp that grows with the number (seconds since 2000, days of 86,400)."""
    days, seconds = divmod(abs(number or 0), 86_400)
    years, days = divmod(days, 336)
    return (f"{(2000 + years) % 10_000:04d}{days // 28 + 1:02d}{days % 28 + 1:02d}"
            f"{seconds // 3600:02d}{seconds // 60 % 60:02d}{seconds % 60:02d}")


def arc_bytes(name: str, version: int, rows: list[tuple[int | None, str | None, bytes]]) -> bytes:
    """One ARC archive: its version block, then a record per (page_id, url, html)."""
    block = f"{version} 0 ledgerlens\n".encode() + ARC_FIELDS[version] + b"\n"
    extra = b" 200 - - 0 " + name.encode() if version == 2 else b""
    out = [f"filedesc://{name} 0.0.0.0 20000101000000 text/plain".encode(), extra, f" {len(block)}\n".encode(), block]
    for page_id, url, html in rows:
        number = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
        doc = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + number + b"\r\n" + html
        extra = b" 200 - - 0 " + name.encode() if version == 2 else b""
        out += [f"\n{_token(url)} 0.0.0.0 {_arc_date(page_id)} text/html".encode(), extra, f" {len(doc)}\n".encode(), doc]
    return b"".join(out) + b"\n"


def to_arc(pages: DataFrame, records: int = RECORDS, max_bytes: int = FILE_BYTES) -> DataFrame:
    """(archive, content): ARC archives of pages (page_id, url, html), versions 1 and 2 in turn.

    An archive has up to ``records`` pages and ``max_bytes`` of html, or one longer page.
    """
    d = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), "url", text_or_empty(F.col("html")).alias("html"), F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                            batch.column(2).cast(pa.binary()).to_pylist()))
            for part in parts([html for _, _, html in rows], max_bytes):
                for at in range(part.start, part.stop, records):
                    name = f"pages-{batch.column(3)[0].as_py():06d}-{n:06d}.arc"
                    content = arc_bytes(name, 1 + n % 2, rows[at:min(at + records, part.stop)])
                    n += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([content], pa.binary())], ["archive", "content"])

    return d.mapInArrow(run, "archive string, content binary")


# ---------------------------------------------------------------- reading ARC

def arc_records(name: str, content: bytes) -> Iterator[dict]:
    """The records of one archive, by its version's header definition.

    The version block names the fields; each later header line has as many,
    and its last field is the length of what follows.  At a line that does not
    fit, or a length that runs past the end, the rest of the archive is one
    row with ``error`` set and nothing else read from it.
    """
    row = dict.fromkeys(("url", "ip", "arc_date", "content_type", "http", "payload", "error"))
    row |= {"archive": name, "arc_version": None}
    at, fields = 0, None
    while True:
        while content[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(content):
            return
        line = content[at:content.find(b"\n", at) if content.find(b"\n", at) >= 0 else len(content)]
        values = line.strip(b"\r").split(b" ")
        begin = at + len(line) + 1
        damaged = not values[-1].isdigit() or begin + int(values[-1]) > len(content)
        if fields is None:
            block = b"" if damaged else content[begin:begin + int(values[-1])]
            head = block.split(b"\n")
            damaged |= not line.startswith(b"filedesc:") or len(head) < 2 or not head[0][:1].isdigit()
            if not damaged:
                version, fields = int(head[0].split(b" ")[0]), head[1].strip().split(b" ")
        else:
            damaged |= len(values) != len(fields)
            if not damaged:
                got = dict(zip(fields, (v.decode("utf-8", "replace") for v in values)))
                doc = content[begin:begin + int(values[-1])]
                http, mark, body = doc.partition(b"\r\n\r\n") if doc.startswith(b"HTTP/") else (b"", b"", doc)
                yield row | {
                    "arc_version": version, "url": got.get(b"URL"), "ip": got.get(b"IP-address"),
                    "arc_date": got.get(b"Archive-date"), "content_type": got.get(b"Content-type"),
                    "http": (http + mark).decode("latin-1"), "payload": body}
        if damaged:
            yield row | {"error": f"unreadable record at byte {at}"}
            return
        at = begin + int(values[-1])


def read_arc(archives: DataFrame) -> DataFrame:
    """The records of ``archives`` (archive, content): one row each, payload without HTTP headers.

    Null or empty content has no records.  Archives that begin otherwise than
    with a version block, or break off, give a row with ``error`` set.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for r in arc_records(name.as_py(), content.as_py() or b""):
                    rows.append(r)
                    size += len(r["payload"] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    text = [(c, pa.string()) for c in ("url", "ip", "arc_date", "content_type", "http")]
    schema = pa.schema([("archive", pa.string()), ("arc_version", pa.int32()), *text, ("payload", pa.binary()), ("error", pa.string())])
    return pick(archives, "archive", "content").mapInArrow(run, RECORD_SCHEMA)


# ---------------------------------------------------------------- converting

def _record_id(*parts: object) -> str:
    """A name-based identifier: the same record gets the same one in every run."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(repr(parts).encode()).digest()[:16], version=5)}>"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _warc_date(arc_date: str | None) -> str:
    d = arc_date if arc_date and re.fullmatch(r"\d{14}", arc_date) else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def warc_record(r: dict) -> bytes:
    """One WARC/1.1 record of a converted row; the end mark is left to the sink."""
    http, payload = (r["http"] or "").encode("latin-1"), r["payload"] or b""
    revisit = r["first"] is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(r['number'], r['url'], r['arc_date'], r['digest'])}",
            f"WARC-Date: {_warc_date(r['arc_date'])}", f"WARC-Target-URI: {r['url'] or '-'}"]
    if r["ip"] and r["ip"] != "0.0.0.0":
        head.append(f"WARC-IP-Address: {r['ip']}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(r['first'], r['first_url'], r['first_date'], r['digest'])}"]
    head += [f"WARC-Payload-Digest: sha1:{r['digest']}", f"WARC-Block-Digest: sha1:{_digest(block)}",
             f"X-Payload-Bytes: {len(payload)}",
             f"Content-Type: {'application/http; msgtype=response' if http else r['content_type'] or 'application/octet-stream'}",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def to_warc(records: DataFrame, path: str, min_bytes: int = 0, per_file: int = RECORDS,
            max_bytes: int = FILE_BYTES) -> None:
    """Write the records of :func:`read_arc`, with a column ``number`` (long), as WARC files under ``path``.

    A file has up to ``per_file`` records and ``max_bytes`` of payload, or one
    longer record: payloads over ``max_bytes / per_file`` go to files of fewer
    records (folder ``long`` beside ``short``), written if there are any.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest number is the response and the others are revisits of it;
    equality is that of SHA-1 and length.  Records without a number are
    responses, and rows that share a number and payload are alike.  Rows with
    ``error`` set are left out (read them from ``records``).

    Only the few revisits are joined to the records, so the payloads move only
    if there are too many of those to broadcast by Spark's own size check.
    """
    good = records.filter("error IS NULL")
    hashed = good.select("number", "url", "arc_date", F.sha1("payload").alias("hash"), F.length("payload").alias("n"))
    hashed = materialize(hashed, "payload-digests")
    longest = hashed.agg(F.max("n")).first()[0] or 0
    hashed = hashed.filter("number IS NOT NULL")
    first = hashed.filter(F.col("n") >= min_bytes).groupBy("hash", "n").agg(
        F.min(F.struct("number", "url", "arc_date")).alias("f"), F.count("*").alias("c")).filter("c > 1")
    first = materialize(first.select(F.col("hash").alias("_hash"), F.col("n").alias("_n"), "f.*"), "first-payloads")
    first = first.withColumnsRenamed({"number": "first", "url": "first_url", "arc_date": "first_date"})
    revisits = hashed.join(first, F.expr("hash = _hash AND n = _n AND number > first")).select(
        F.col("number").alias("_number"), F.col("hash").alias("_hash"), "first", "first_url", "first_date").distinct()
    revisits = materialize(revisits, "revisits")
    rows = good.withColumn("hash", F.sha1("payload")).join(revisits, F.expr("number = _number AND hash = _hash"), "left").select(
        "number", "url", "ip", "arc_date", "content_type", "http", "payload", "first", "first_url", "first_date")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                out = [warc_record(r | {"digest": _digest(r["payload"] or b"")}) for r in batch.slice(at, 200).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    def write(some: DataFrame, folder: str, count: int) -> None:
        # the text sink writes a string's bytes as they are, and the cast leaves them alone
        (some.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write
         .option("lineSep", WARC_END).option("maxRecordsPerFile", count).text(f"{path}/{folder}"))

    long = F.coalesce(F.length("payload"), F.lit(0)) > max_bytes // per_file
    write(rows.filter(~long), "short", per_file)
    if longest > max_bytes // per_file:
        write(rows.filter(long), "long", max(1, max_bytes // longest))


# ---------------------------------------------------------------- reading WARC

def warc_records(content: bytes) -> Iterator[dict]:
    """Headers (lower-case names) and block of each record of a WARC file, by declared lengths."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = end + 4
        block = content[begin:begin + int(head["content-length"])]
        if len(block) < int(head["content-length"]):
            raise ValueError(f"record at byte {at} is cut off")
        yield head | {"block": block}
        at = begin + len(block) + len(WARC_END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files under ``path``.

    record_type, record_id, refers_to_id, url, date, http, payload (null for
    revisits), payload_bytes and payload_digest (bare base32, of the full
    payload).  A response's digest and length are those of the payload read;
    if they differ from its headers, the read fails.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option(
        "recursiveFileLookup", "true").load(path).select("content")
    names = ("record_type", "record_id", "refers_to_id", "url", "date", "http", "payload_digest")
    schema = pa.schema([*((c, pa.string()) for c in names), ("payload", pa.binary()), ("payload_bytes", pa.int64())])

    def row(r: dict) -> dict:
        out = {"record_type": r["warc-type"], "record_id": r["warc-record-id"], "refers_to_id": r.get("warc-refers-to"),
               "url": r.get("warc-target-uri"), "date": r.get("warc-date"),
               "payload_digest": r["warc-payload-digest"].removeprefix("sha1:"), "payload_bytes": int(r["x-payload-bytes"])}
        block = r["block"]
        http, mark, body = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
        out |= {"http": (http + mark).decode("latin-1"), "payload": None if out["record_type"] == "revisit" else body}
        if out["payload"] is not None and (_digest(body), len(body)) != (out["payload_digest"], out["payload_bytes"]):
            raise ValueError(f"payload of {out['record_id']} differs from its digest")
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for r in warc_records(content.as_py()):
                    rows.append(row(r))
                    size += len(r["block"])
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(run, ", ".join(f"{c} string" for c in names) + ", payload binary, payload_bytes long")


def page_number(http: str = "http"):
    """The page_id that the HTTP headers carry (null without one)."""
    return F.expr(f"try_cast(regexp_extract({http}, 'X-Page-Id: (-?[0-9]+)', 1) AS bigint)")


def convert_pages(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Pages as ARC archives, converted to WARC files under ``path`` and read back.

    Per row of ``pages`` (page_id, url, html): page_id, payload_bytes,
    payload_digest, record_type, refers_to (page_id of the response, for
    revisits), url and date.  A null html is an empty payload; white space in
    a url is percent-encoded, a null or empty one is "-"; rows with a null
    page_id are responses.  Empty tables give empty results.
    """
    spark = pages.sparkSession
    records = read_arc(to_arc(pages)).withColumn("number", page_number())
    to_warc(records, path, min_bytes)
    found = materialize(read_warc(spark, path).drop("payload").withColumn("page_id", page_number()), "warc-index")
    responses = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to")).distinct()
    return found.join(responses, F.expr("record_type = 'revisit' AND refers_to_id = _id"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "date")
