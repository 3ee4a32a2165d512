"""Legacy ARC archives to WARC, and WARC files as Spark output and input.

ARC files open with a version block; each record is one header line, whose fields
depend on the version, and as many bytes as it declares. The converter reads the
fields by the version's names and writes equivalent WARC headers: identifiers
derived from the record, timestamps, types and digests. Equal payloads of some
size are stored once; the others become revisits of that record.

WARC files are text-sink output: a record is one value, and the line separator is
the blank line that ends a WARC record, so that every part file is a WARC file.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import ensure_checkpoints, keyed, located, map_batches

REVISIT_BYTES = 1000            # payloads from this size on are stored once
SEGMENT_BYTES = 8 << 20         # of an archive, about
#: Header fields by ARC version (fixed by the format).
ARC_FIELDS = {
    1: ["url", "ip", "date", "type", "length"],
    2: ["url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"],
}
ARC_NAMES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


# ------------------------------------------------------------------ ARC records

def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_NAMES[version]}\n\n".encode()
    more = f" 200 - - 0 {name}" if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{more} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, name: str, offset: int, url: str, date: str, block: bytes) -> bytes:
    more = f" 200 {hashlib.md5(block).hexdigest()} - {offset} {name}" if version == 2 else ""
    return f"{url} 127.0.0.1 {date} text/html{more} {len(block)}\n".encode() + block + b"\n"


def render_arc(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``name, content``: ARC segments, by turns of version 1 and 2, that hold the
    rows of ``pages`` (``page_id, url, html``) as HTTP responses. A null html is an
    empty payload, a null url ``about:blank``; row key and id travel as HTTP fields."""
    rows = keyed(located(pages.select("page_id", "url", "html"))).select(F.col("page_id").cast("string"), "url", F.col("html").cast("binary"),
                               F.col("__k1"), F.col("__k2"))
    date = "20240101000000"

    def run(batches):
        number = 0
        for batch in batches:
            held, size, version, name = [], 0, 1, ""
            for page, url, html, k1, k2 in zip(*(c.to_pylist() for c in batch.columns)):
                if not held:
                    version = 1 + number % 2
                    name = f"{k1 & 0xffffffffffffffff:016x}-{k2}.arc"
                    held = [arc_version_block(version, name, date)]
                    size = len(held[0])
                html = html or b""
                fields = [f"X-Page-Row: {k1}/{k2}", f"Content-Length: {len(html)}"]
                if page is not None:
                    fields.append(f"X-Page-Id: {page}")
                block = ("HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n" + "\r\n".join(fields) + "\r\n\r\n").encode() + html
                address = "".join(f"%{ord(c):02X}" if ord(c) <= 32 else c for c in url) if url else "about:blank"
                held.append(arc_record(version, name, size, address, date, block))
                size += len(held[-1])
                if size >= segment_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(held)], pa.binary())], names=["name", "content"])
                    held, number = [], number + 1
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(held)], pa.binary())], names=["name", "content"])
                number += 1

    return map_batches(rows, run, "name string, content binary")


def read_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an ARC file, the version block
    first. A record whose declared length runs past the end, or whose line lacks
    fields, raises ``ValueError``."""
    if content[:2] == b"\x1f\x8b":
        content = gunzip(content)
    at, version = 0, 1
    while at < len(content):
        end = content.find(b"\n", at)
        line = content[at:end if end >= 0 else len(content)].decode("utf-8", "replace").rstrip("\r")
        if not line.strip():
            at = end + 1 if end >= 0 else len(content)
            continue
        fields = line.split(" ")
        if line.startswith("filedesc:"):
            # the version block names its own version on the line below
            version = int(content[end + 1:content.find(b" ", end + 1)])
            names = ARC_FIELDS.get(version)
            if names is None:
                raise ValueError(f"ARC version {version}")
            head = dict(zip(names if len(fields) == len(names) else ARC_FIELDS[1], fields))
            head["length"] = fields[-1]
        else:
            names = ARC_FIELDS[version]
            if len(fields) < len(names):
                raise ValueError(f"ARC header {line[:200]!r}")
            # an unescaped blank can only be in the first field
            extra = len(fields) - len(names)
            head = dict(zip(names, [" ".join(fields[:extra + 1]), *fields[extra + 1:]]))
        size = int(head["length"])
        block = content[end + 1:end + 1 + size]
        if len(block) < size:
            raise ValueError(f"ARC record of {size} bytes is cut off: {line[:200]!r}")
        yield head, block
        at = end + 1 + size


def gunzip(content: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while content:
        one = zlib.decompressobj(31)
        out.append(one.decompress(content))
        content = one.unused_data
    return b"".join(out)


def warc_date(stamp: str) -> str:
    """ISO time of a 14-digit ARC date (missing digits: the earliest such time)."""
    digits = (stamp + "00000101000000"[len(stamp):])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """(head with its blank line, payload) of an HTTP response, None for others."""
    if not block.startswith(b"HTTP/"):
        return None
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def http_field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode()
    return None


RECORD_SCHEMA = ("record_id string, warc_type string, uri string, ip string, date string, mime string, head binary, payload binary, "
                 "payload_bytes long, digest string, page_id long, k1 long, k2 long")


def convert_arc(archives: DataFrame) -> DataFrame:
    """WARC fields of every record of ARC files (``name, content``, as ``render_arc``
    or a ``binaryFile`` scan gives them): version blocks become ``warcinfo``, HTTP
    responses ``response``, others ``resource``. Equal archives give equal identifiers."""

    def run(batches):
        for batch in batches:
            rows = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for head, block in read_arc(content or b""):
                    url = head["url"]
                    parts = http_parts(block)
                    http, payload = parts or (b"", block)
                    digest = hashlib.sha1(payload).hexdigest()
                    kind = "warcinfo" if url.startswith("filedesc:") else "response" if parts else "resource"
                    row = (http_field(http, b"x-page-row") or "").split("/") if parts else [""]
                    page = http_field(http, b"x-page-id") if parts else None
                    key = f"{name} {url} {head['date']} {digest} {'/'.join(row)}"
                    rows.append((f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}", kind, url, head["ip"], warc_date(head["date"]),
                                 head["type"], http, payload, len(payload), digest, None if page is None else int(page),
                                 int(row[0]) if len(row) == 2 else None, int(row[1]) if len(row) == 2 else None))
            types = [pa.string()] * 6 + [pa.binary()] * 2 + [pa.int64(), pa.string()] + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 13, types)],
                                             names=[f.split()[0] for f in RECORD_SCHEMA.split(", ")])

    return map_batches(archives.select("name", "content"), run, RECORD_SCHEMA)


# ----------------------------------------------------------------- WARC records

def with_revisits(records: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``records`` plus ``first``: the record (``record_id, page_id, uri, date``) that
    holds a payload stored once, for those that only refer to it."""
    large = records.filter((F.col("payload_bytes") >= least_bytes) & (F.col("warc_type") == "response"))
    first = large.groupBy("digest").agg(
        F.max(F.struct("page_id", "k1", "k2", "record_id", "uri", "date")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = records.join(first.select("digest", "first"), "digest", "left")
    refers = (F.col("payload_bytes") >= least_bytes) & (F.col("warc_type") == "response") & (
        F.col("record_id") != F.col("first.record_id"))
    return joined.withColumn("first", F.when(refers, F.col("first")))


def warc_records(records: DataFrame) -> DataFrame:
    """``record``: each record's WARC bytes without the closing blank line. A
    revisit keeps the HTTP head and drops the payload."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first = r["first"]
                body = r["head"] if first else r["head"] + r["payload"]
                kind = "revisit" if first else r["warc_type"]
                sha = "sha1:" + b32encode(bytes.fromhex(r["digest"])).decode()
                fields = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{r['record_id']}>", f"WARC-Date: {r['date']}",
                          f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: {sha}",
                          f"WARC-Block-Digest: sha1:{b32encode(hashlib.sha1(body).digest()).decode()}"]
                if first:
                    fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                               f"WARC-Refers-To: <{first['record_id']}>", f"WARC-Refers-To-Target-URI: {first['uri']}",
                               f"WARC-Refers-To-Date: {first['date']}"]
                    if first["page_id"] is not None:
                        fields.append(f"X-Refers-To-Page: {first['page_id']}")
                mime = "application/http;msgtype=response" if kind in ("response", "revisit") else r["mime"]
                fields += [f"Content-Type: {mime}", f"Content-Length: {len(body)}"]
                out.append("\r\n".join(fields).encode() + b"\r\n\r\n" + body)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return map_batches(records, run, "record binary")


def write_warc(records: DataFrame, path: str, records_per_file: int) -> None:
    """Gzipped WARC part files of at most so many records each."""
    # raw bytes as a string value: the text sink writes them as they are
    (warc_records(records).select(F.col("record").cast("string").alias("value")).write
        .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", records_per_file).text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record_type, record_id, refers_to_id, uri, date, page_id, refers_to,
    payload_bytes, payload_digest`` of the WARC files in a folder, read by their
    declared lengths. Digests of stored payloads are computed and must equal the
    declared ones; a revisit's come from its headers."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    schema = ("record_type string, record_id string, refers_to_id string, uri string, date string, page_id long, refers_to long, "
              "payload_bytes long, payload_digest string")

    def number(x):
        return None if x is None else int(x)

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows = [_warc_row(h, b, number) for h, b in iterate_warc(content)]
                columns = zip(*rows) if rows else [[]] * 9
                types = [pa.string()] * 5 + [pa.int64()] * 3 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 names=[f.split()[0] for f in schema.split(", ")])

    return map_batches(files, run, schema)


def iterate_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of a WARC file, gzipped or not."""
    if content[:2] == b"\x1f\x8b":
        content = gunzip(content)
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head["content-length"])
        block = content[end + 4:end + 4 + size]
        if len(block) < size:
            raise ValueError(f"WARC record of {size} bytes is cut off")
        yield head, block
        at = end + 4 + size + 4


def _warc_row(head: dict[str, str], block: bytes, number) -> tuple:
    from base64 import b32decode
    kind = head["warc-type"]
    http, payload = http_parts(block) or (b"", block)
    declared = b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = len(payload)
    if kind == "revisit":
        size = number(http_field(http, b"content-length"))
    elif hashlib.sha1(payload).hexdigest() != declared:
        raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
    return (kind, head["warc-record-id"].strip("<>"), (head.get("warc-refers-to") or "").strip("<>") or None,
            head.get("warc-target-uri"), head["warc-date"], number(http_field(http, b"x-page-id")) if http else None,
            number(head.get("x-refers-to-page")), size, declared)


def convert_pages(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages through ARC and WARC: render, convert, write under the shared folder,
    read back. One row per page (see ``read_warc``); version blocks are left out.

    Of equal payloads of ``least_bytes`` or more, the largest page id is stored (of
    equal ids, the row later in the input); null html is an empty payload, and
    pages without an id lose to others.
    """
    spark = pages.sparkSession
    ensure_checkpoints(spark)
    records = convert_arc(render_arc(pages)).filter("warc_type != 'warcinfo'")
    shape = pages.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("html")).alias("b")).first()
    per_file = max(1, int(SEGMENT_BYTES * shape.n / max(1, (shape.b or 0) + 500 * shape.n)))
    path = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4()}"
    write_warc(with_revisits(records, least_bytes), path, per_file)
    return read_warc(spark, path)
