"""Legacy archive converter: ARC files to WARC files.

An ARC file begins with a version block (``filedesc://``) whose body names the version; each record is
a header line and as many bytes as the line declares. Version 1 lines have five fields (URL, address,
date, type, length), version 2 lines ten (result code, checksum, location, offset and file name before
the length). ``read_arc`` parses both by the declared lengths, never by separators. ``convert`` gives
each record what WARC asks for: an identifier (a UUID of the file, offset, URL and date), the date in
ISO form, a type (``warcinfo`` for version blocks, ``response`` for HTTP documents, else ``resource``)
and a base-32 SHA-1 payload digest. Of equal payloads the one with the smallest page id stays a
response; the others become ``revisit`` records without payload that refer to it.

Files are written by Spark's text writer, whose line separator is the format's record separator (a line
feed after an ARC document, two CRLF after a WARC block), gzip-compressed, about ``ARCHIVE_BYTES`` of records
each, and read with ``binaryFile``, so both work on any file system that Spark knows and a task holds
one archive at a time. Digests are grouped before the join; a table of repeated digests beyond
``MAX_BROADCAST`` rows is joined by a shuffle that adaptive execution can split.

Defined results: null html is an empty payload; null page_id is a record without id, null url is "-";
white space and control characters in a URL are percent-coded; repeated rows give one response and
revisits; a null page_id is a response only if no equal payload has an id; an empty table gives no rows
(archives of no records). Extra columns are ignored. Lines that are no header are passed over.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import broadcast_if_small, scratch_path, stored

ARCHIVE_BYTES = 16 << 20
MAX_BROADCAST = 100_000
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
#: compression at speed: archives here are intermediate files
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_arc(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Writes pages (page_id, url, html) as ARC files, versions 1 and 2 by turns; returns their number.
    The page id travels in the document's HTTP header."""
    spark = pages.sparkSession
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    archives = max(1, -(-size // archive_bytes))
    body = F.coalesce("html", F.lit(""))
    date = F.date_format(F.timestamp_seconds(1_700_000_000 + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10_000_000))), "yyyyMMddHHmmss")
    url = F.regexp_replace(F.coalesce("url", F.lit("-")), r"[\x00-\x20\x7F]", "%20")
    doc = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                   F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col("page_id"), F.lit("\r\n")), F.lit("")),
                   F.lit("Content-Length: "), F.octet_length(body), F.lit("\r\n\r\n"), body)
    rows = pages.select(F.pmod(F.xxhash64(F.monotonically_increasing_id(), "page_id"), F.lit(archives)).alias("archive"),
                        url.alias("url"), date.alias("date"), doc.alias("doc"))
    one = F.concat_ws(" ", "url", F.lit("0.0.0.0"), "date", F.lit("text/html"), F.octet_length("doc"))
    two = F.concat_ws(" ", "url", F.lit("0.0.0.0"), "date", F.lit("text/html"), F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"),
                      F.concat(F.lit("pages-"), "archive", F.lit(".arc")), F.octet_length("doc"))
    version = F.when(F.col("archive") % 2 == 0, 1).otherwise(2)
    records = rows.select("archive", F.lit(1).alias("no"), F.concat(F.when(version == 1, one).otherwise(two), F.lit("\n"), "doc").alias("value"))
    block = F.concat(F.when(version == 1, F.lit("1 0 kiln\n" + ARC_FIELDS[1] + "\n")).otherwise(F.lit("2 0 kiln\n" + ARC_FIELDS[2] + "\n")))
    line = F.concat_ws(" ", F.concat(F.lit("filedesc://pages-"), "archive", F.lit(".arc")), F.lit("0.0.0.0 20240101000000 text/plain"),
                       F.when(version == 2, F.lit("200 - - 0 pages.arc")), F.octet_length(block))
    heads = spark.range(archives).select(F.col("id").alias("archive"), F.lit(0).alias("no"), F.concat(line, F.lit("\n"), block).alias("value"))
    (heads.unionByName(records).repartition(archives, "archive").sortWithinPartitions("archive", "no").drop("no")
     .write.partitionBy("archive").options(**_GZIP).option("lineSep", "\n").text(path))
    return archives


def arc_records(data: bytes) -> Iterator[tuple[int, int, list[str], bytes]]:
    """(version, offset, header fields, document) of each record of an ARC file."""
    at, version = 0, 1
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        fields = data[at:end].decode("utf-8", "replace").split(" ")
        head = fields[0].startswith("filedesc://")
        if len(fields) != (5 if version == 1 else 10) and not (head and len(fields) in (5, 10)) or not fields[-1].isdigit():
            at = end + 1
            continue
        doc = data[end + 1:end + 1 + int(fields[-1])]
        if head and doc[:1].isdigit():
            version = int(doc[:1])
        yield version, at, fields, doc
        at = end + 1 + int(fields[-1]) + 1


def _uuid(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _http(doc: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """(header with its empty line, payload, fields) of an HTTP document; no header: all payload."""
    cut = doc.find(b"\r\n\r\n") if doc.startswith(b"HTTP/") else -1
    if cut < 0:
        return b"", doc, {}
    fields = dict(x.split(": ", 1) for x in doc[:cut].decode("latin-1").split("\r\n")[1:] if ": " in x)
    return doc[:cut + 4], doc[cut + 4:], fields


def _unzip(data: bytes) -> bytes:
    return zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data


_FIELDS = "page_id long, record_id string, url string, address string, date string, mime string, type string, digest string"
_TYPES = [pa.int64()] + [pa.string()] * 7


def _parse_arc(with_document: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _FIELDS.split(", ")] + ["head", "payload"] * with_document
        types = _TYPES + [pa.binary(), pa.binary()] * with_document
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, size = [], 0
                for _, offset, f, doc in arc_records(_unzip(content.as_py())):
                    if f[0].startswith("filedesc://"):
                        continue
                    head, payload, fields = _http(doc)
                    page = fields.get("X-Page-Id")
                    date = f"{f[2][:4]}-{f[2][4:6]}-{f[2][6:8]}T{f[2][8:10]}:{f[2][10:12]}:{f[2][12:14]}Z"
                    row = (int(page) if page else None, _uuid(path.rsplit("/archive=", 1)[-1], str(offset), f[0], f[2]), f[0], f[1], date,
                           f[3], "response" if head else "resource", digest32(payload))
                    rows.append((*row, head, payload) if with_document else row)
                    size += len(doc) if with_document else 100
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    return run


def read_arc(spark: SparkSession, path: str, with_document: bool = True) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_parse_arc(with_document), _FIELDS + (", head binary, payload binary" if with_document else ""))


def _warc(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))] if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def _to_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = True
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if first:
                out.append(_warc([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _uuid("info", r["record_id"])), ("WARC-Date", r["date"]),
                                  ("Content-Type", "application/warc-fields")], b"software: kiln\r\nformat: WARC/1.1\r\n"))
                first = False
            again = r["of_record"] is not None and r["of_record"] != r["record_id"]
            head = [("WARC-Type", "revisit" if again else r["type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["date"]),
                    ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["address"]), ("WARC-Payload-Digest", "sha1:" + r["digest"]),
                    ("Content-Type", "application/http; msgtype=response" if r["head"] else r["mime"])]
            if again:
                head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", r["of_record"]),
                         ("WARC-Refers-To-Target-URI", r["of_url"]), ("WARC-Refers-To-Date", r["of_date"]),
                         ("X-Refers-To-Page", None if r["of_page"] is None else str(r["of_page"]))]
            out.append(_warc(head, r["head"] + (b"" if again else r["payload"])))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, archives: int) -> None:
    """Converts the ARC files below ``arc_path`` to WARC files; equal payloads are stored once."""
    seen = read_arc(spark, arc_path, with_document=False)
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", F.col("record_id").alias("of_record"), F.col("url").alias("of_url"),
                           F.col("date").alias("of_date"), F.col("page_id").alias("of_page")))
    again = seen.filter("type = 'response'").groupBy("digest").agg(first.alias("r"), F.count("*").alias("n")).filter("n > 1")
    again = stored(again.select("digest", "r.of_record", "r.of_url", "r.of_date", "r.of_page"), "warc-repeated")
    records = read_arc(spark, arc_path).join(broadcast_if_small(again, MAX_BROADCAST), "digest", "left")
    files = spark.read.format("binaryFile").load(arc_path).select("length").agg(F.count("*")).first()[0]
    per_file = max(1, -(-seen.count() // max(files, archives, 1)))
    (records.mapInArrow(_to_warc, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.options(**_GZIP).option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(warc_path))


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a WARC file."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:])
        stop = end + 4 + int(fields["Content-Length"])
        yield fields, data[end + 4:stop]
        at = stop


def _parse_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for fields, block in warc_records(_unzip(content.as_py())):
                kind = fields["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                _, payload, http = _http(block)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(http["Content-Length"]) if kind == "revisit" else len(payload)
                if kind == "response" and digest32(payload) != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
                page, other = http.get("X-Page-Id"), fields.get("X-Refers-To-Page")
                rows.append((int(page) if page else None, size, digest, kind, int(other) if other else None, fields["WARC-Record-ID"]))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id of the page records."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse_warc, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string")


def archived(pages: DataFrame) -> DataFrame:
    """Pages to ARC files, these to WARC files, and the WARC files read back."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    n = write_arc(pages, arc)
    convert(spark, arc, warc, n)
    return read_warc(spark, warc)
