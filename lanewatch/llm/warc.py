"""Legacy archive converter: ARC files in, equivalent WARC files out.

An ARC file opens with a ``filedesc:`` record whose body names the version and the
fields of the URL lines; version 1 has five fields, version 2 ten. Records are cut
by the declared length alone. Each becomes a WARC record: an identifier derived
from archive and offset, the 14-digit date as ISO time, a type (``filedesc:``
warcinfo, HTTP responses response or revisit, everything else resource), SHA-1
digests of block and payload. Of records with equal payloads of at least
``min_bytes`` the one with the largest page id is the response, the others are
revisits of it.

Archives are written by Spark's text writer, one row a file (so the file sizes are
bounded by ``segment``, or one record), and read as binary files: any store that
Spark reaches will do. Payloads travel once, as compressed archives; what is equal
is decided on digests.

Defined results: null html is an empty payload; a null url becomes an
``urn:page:`` name, blanks in urls are percent-encoded; equal rows are separate
records (the last by archive and offset is the response); a null page id sorts
before all others; no pages give no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewatch.llm import textops
from lanewatch.llm.common import kept, read, register, remove_dir, scratch_dir, shuffle_partitions

#: URL line fields by ARC version (fixed by the format)
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = re.compile(rb"[\x00-\x20\x7f]")
RECORD = ("path string, offset long, page_id long, record_id string, uri string, date string, payload_bytes long, "
          "sha1 string, sha256 binary")


# ---- ARC

def arc_record(version: int, uri: bytes, date: str, content_type: str, status: int, content: bytes, offset: int, name: str) -> bytes:
    uri = SPACE.sub(lambda m: b"%%%02X" % m[0][0], uri)
    if version == 1:
        line = f" 0.0.0.0 {date} {content_type} {len(content)}\n"
    else:
        line = f" 0.0.0.0 {date} {content_type} {status} {hashlib.md5(content).hexdigest()} - {offset} {name} {len(content)}\n"
    return uri + line.encode() + content + b"\n"


def arc_head(version: int, name: str, date: str, origin: str = "lanewatch") -> bytes:
    body = f"{version} 0 {origin}\n{FIELDS[version]}\n".encode()
    tail = " ".join(["200", "-", "-", "0", name]) + " " if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {tail}{len(body)}\n".encode() + body + b"\n"


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, URL line fields, content) of every record of an ARC file, the ``filedesc:`` record first."""
    end = data.index(b"\n")
    head = data[:end].split(b" ")
    if not head[0].startswith(b"filedesc:"):
        raise ValueError("an ARC file starts with a filedesc record")
    body = data[end + 1:end + 1 + int(head[-1])]
    version, names = body.split(b"\n")[:2]
    version, names = int(version.split(b" ")[0]), names.decode().split(" ")
    if version not in FIELDS or names != FIELDS[version].split(" "):
        raise ValueError(f"ARC version {version} with fields {names}")
    at = 0
    while at < len(data):
        if data[at] == 0x0A:                 # newlines between records
            at += 1
            continue
        end = data.index(b"\n", at)
        values = data[at:end].decode("utf-8", "surrogateescape").split(" ")
        if len(values) != len(names):
            raise ValueError(f"URL line at {at} has {len(values)} fields, version {version} has {len(names)}")
        length = int(values[-1])
        content = data[end + 1:end + 1 + length]
        if len(content) != length:
            raise ValueError(f"record at {at}: {length} bytes declared, {len(content)} left")
        yield at, dict(zip(names, values, strict=True)), content
        at = end + 1 + length


def http_parts(content: bytes) -> tuple[bytes, bytes]:
    """Header block (with its blank line) and payload of an HTTP message."""
    for gap in (b"\r\n\r\n", b"\n\n"):
        if (at := content.find(gap)) >= 0:
            return content[:at + len(gap)], content[at + len(gap):]
    return content, b""


def _header(block: bytes, name: bytes) -> bytes | None:
    m = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", block)
    return m[1] if m else None


def write_arc(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
              date: str = "20240101000000", segment: int = 8 << 20) -> None:
    """Pages as ARC files (versions 1 and 2 in turn), each page an HTTP response."""
    slim = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held, size, version, name = TaskContext.get().partitionId(), 0, [], 0, 1, ""
        for whole in batches:
            for batch in textops.slices(whole, "html", segment):
                for i, u, h in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(),
                                   batch.column("html").to_pylist(), strict=True):
                    if not held:
                        version, name = 1 + (task + n) % 2, f"pages-{task:05d}-{n:05d}.arc"
                        held, size = [arc_head(version, name, date)], 0
                    payload = (h or "").encode()
                    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    head += f"Content-Length: {len(payload)}\r\n" + (f"X-Page-Id: {i}\r\n" if i is not None else "") + "\r\n"
                    uri = f"urn:page:{i}" if u is None else u
                    held.append(arc_record(version, uri.encode(), date, "text/html", 200, head.encode() + payload, size, name))
                    size += len(held[-1])
                    if size >= segment:
                        yield _file(held)
                        held, n = [], n + 1
        if held:
            yield _file(held)

    _write(slim.mapInArrow(run, "value binary"), folder)


def _file(parts: list[bytes]) -> pa.RecordBatch:
    """One row that becomes one file; the text writer adds the closing newline."""
    return pa.RecordBatch.from_arrays([pa.array([b"".join(parts).removesuffix(b"\n")], pa.binary())], ["value"])


def _write(rows: DataFrame, folder: str) -> None:
    # archives of a run are read once or twice: quick compression
    rows.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "gzip") \
        .option("zlib.compress.level", "BEST_SPEED").text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def _plain(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


# ---- WARC

def _iso(date: str) -> str:
    d = (date + "00000000000000")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _b32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _record_id(path: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path.rsplit("/", 1)[-1]}#{offset}')}>"


def warc_record(kind: str, record_id: str, uri: str, date: str, content_type: str, block: bytes, payload: bytes | None,
                more: dict[str, str]) -> bytes:
    fields = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date}
    if uri:
        fields["WARC-Target-URI"] = uri
    if payload is not None:
        fields |= {"WARC-Payload-Digest": _b32(hashlib.sha1(payload).digest()), "WARC-Payload-Length": str(len(payload))}
    fields |= {"WARC-Block-Digest": _b32(hashlib.sha1(block).digest()), **more, "Content-Type": content_type,
               "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode("utf-8", "surrogateescape") + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        length = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + length]
        at = end + 4 + length
        if len(block) != length or data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record of {length} bytes is cut short")
        at += 4
        yield fields, block


def _message(fields: dict[str, str], content: bytes) -> tuple[str, bytes, bytes]:
    """WARC type, block headers and payload of an ARC record."""
    if fields["URL"].startswith("filedesc:"):
        return "warcinfo", b"", content
    if content.startswith(b"HTTP/"):
        return "response", *http_parts(content)
    return "resource", b"", content


def arc_records(spark: SparkSession, folder: str) -> DataFrame:
    """What the conversion decides on: one slim row per HTTP record of the ARC files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("record_id", pa.string()),
                          ("uri", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()), ("sha1", pa.string()),
                          ("sha256", pa.binary())])
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                data = _plain(content.as_py())
                for offset, fields, body in parse_arc(data) if data.strip() else ():
                    what, head, payload = _message(fields, body)
                    if what == "response":
                        own = _header(head, b"X-Page-Id")
                        rows.append({"path": path, "offset": offset, "page_id": int(own) if own else None,
                                     "record_id": _record_id(path, offset), "uri": fields["URL"], "date": fields["Archive-date"],
                                     "payload_bytes": len(payload), "sha1": hashlib.sha1(payload).hexdigest(),
                                     "sha256": hashlib.sha256(payload).digest()})
                yield pa.RecordBatch.from_pylist(rows, kind)

    return _files(spark, folder).mapInArrow(run, RECORD)


def convert(spark: SparkSession, arc: str, warc: str, *, min_bytes: int = 1000, task_bytes: int = 32 << 20,
            broadcast_bytes: int = 16 << 20) -> None:
    """ARC files of a folder to WARC files in another, equal payloads as revisits (their list is broadcast up to a size)."""
    records = kept(arc_records(spark, arc))
    latest = F.max(F.struct("page_id", "path", "offset", "record_id", "uri", "date")).alias("first")
    shared = records.filter(F.col("payload_bytes") >= min_bytes).groupBy("sha256", "payload_bytes") \
        .agg(latest, F.count("*").alias("n")).filter("n > 1")
    revisits = records.join(shared, ["sha256", "payload_bytes"]).filter(F.col("record_id") != F.col("first.record_id"))
    by_file = revisits.groupBy("path").agg(F.collect_list(F.struct(
        "offset", "first.record_id", "first.uri", "first.date")).alias("revisits"))
    listed = revisits.agg(F.sum(F.length("first.record_id") + F.length("first.uri") + F.length("path") + 64)).first()[0] or 0
    if listed <= broadcast_bytes:
        files = _files(spark, arc).join(F.broadcast(by_file), "path", "left")
    else:           # whole files meet their revisits: as many tasks as their bytes need
        size = spark.read.format("binaryFile").load(arc).agg(F.sum("length")).first()[0] or 0
        tasks = max(shuffle_partitions(spark), -(-size // task_bytes))
        files = _files(spark, arc).repartition(tasks, "path").join(by_file.repartition(tasks, "path"), "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, data = batch.column("path")[i].as_py(), _plain(batch.column("content")[i].as_py())
                if not data.strip():
                    continue
                firsts = {x["offset"]: x for x in batch.column("revisits")[i].as_py() or ()}
                out = []
                for offset, fields, body in parse_arc(data):
                    what, head, payload = _message(fields, body)
                    at = (_record_id(path, offset), fields["URL"], _iso(fields["Archive-date"]))
                    if what == "warcinfo":
                        out.append(warc_record(what, at[0], "", at[2], "application/warc-fields",
                                               f"software: lanewatch\r\nformat: WARC File Format 1.1\r\nisPartOf: {at[1]}\r\n".encode(),
                                               None, {}))
                    elif what == "resource":
                        out.append(warc_record(what, *at, fields["Content-type"], body, payload, {}))
                    elif (first := firsts.get(offset)) is not None:
                        out.append(warc_record("revisit", *at, "application/http;msgtype=response", head, payload, {
                            "WARC-Profile": PROFILE, "WARC-Refers-To": first["record_id"],
                            "WARC-Refers-To-Target-URI": first["uri"], "WARC-Refers-To-Date": _iso(first["date"])}))
                    else:
                        out.append(warc_record(what, *at, "application/http;msgtype=response", head + payload, payload, {}))
                yield _file(out)

    _write(files.mapInArrow(run, "value binary"), warc)


def warc_records(spark: SparkSession, folder: str) -> DataFrame:
    """The response and revisit records of WARC files, digests checked against what the records hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                          ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers", pa.string())])
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in parse_warc(_plain(content.as_py())):
                    what = fields["WARC-Type"]
                    if _b32(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
                        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
                    if what not in ("response", "revisit"):
                        continue
                    head, payload = http_parts(block)
                    digest = fields["WARC-Payload-Digest"]
                    if what == "response" and (_b32(hashlib.sha1(payload).digest()) != digest
                                               or len(payload) != int(fields["WARC-Payload-Length"])):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']}")
                    own = _header(head, b"X-Page-Id")
                    rows.append({"page_id": int(own) if own else None, "record_id": fields["WARC-Record-ID"], "record_type": what,
                                 "payload_bytes": int(fields["WARC-Payload-Length"]),
                                 "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(),
                                 "refers": fields.get("WARC-Refers-To")})
                yield pa.RecordBatch.from_pylist(rows, kind)

    return _files(spark, folder).mapInArrow(run, "page_id long, record_id string, record_type string, payload_bytes long, "
                                                 "payload_digest string, refers string")


def page_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (the page of the record referred to)."""
    named = records.filter("record_type = 'response'") \
        .join(records.filter("refers is not null").select(F.col("refers").alias("record_id")).distinct(), "record_id", "left_semi") \
        .select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"))
    return records.join(named, "refers", "left") \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
             max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM q
"""


@register("op4_warc", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(read(spark, sf_dir, "pages"), arc)
    convert(spark, arc, warc)
    out = kept(page_records(kept(warc_records(spark, warc))))
    remove_dir(spark, arc)
    remove_dir(spark, warc)
    return out
