"""WARC archives: writing, reading, and revisit resolution by payload digest.

An archive is a folder of WARC/1.1 files, each a gzip stream of its records.
Spark's text writer writes them (a record per row, the record separator as
line separator), so they go wherever Spark can write, with its commit
protocol; the writer closes a file after ``RECORDS_PER_FILE`` records. They
are read as whole files and parsed by Content-Length; files of other origin
may be plain, or gzip with a member per record.

``deduplicate`` reads the headers of an archive, shuffles them by payload
digest, lets the record with the largest page number of each digest answer
for all (a pre-aggregated maximum, so a digest that a third of all records
share is one row a task), joins the records to it and writes a new archive
with fresh headers: a response with its payload, or a revisit that names the
response and has none. A revisit that the input archive already holds takes
part by the digest it names.

Defined results: a null payload is empty; a null page number is written
without page header and is smaller than any other. Records equal in digest
and page number answer each for itself: if theirs is the largest, all are
responses. Payloads of fewer than ``least`` bytes are always responses. An
empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import own_columns
from tidewater.session import fresh_dir

RECORDS_PER_FILE = 2000
SEPARATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
DATE = "2024-01-01T00:00:00Z"

_RECORD = "page_id long, uri string, record_type string, digest string, refers_to long, payload binary, payload_bytes long"
_FIELDS = [("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()), ("digest", pa.string()),
           ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64())]


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(name: str, value) -> str:
    return "" if value is None else f"{name}: {re.sub(r'[\r\n]+', ' ', str(value))}\r\n"


def render(page_id, uri, record_type, digest, refers_to, payload: bytes, payload_bytes: int) -> bytes:
    """A record up to its closing separator. ``X-Page-Id`` and the like carry
    the table's numbers beside the standard fields."""
    body = payload if record_type == "response" else b""
    name = hashlib.md5(f"{page_id} {uri} {digest}".encode(), usedforsecurity=False).hexdigest()
    head = ("WARC/1.1\r\n" + _header("WARC-Type", record_type)
            + f"WARC-Record-ID: <urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:]}>\r\n"
            + f"WARC-Date: {DATE}\r\n" + _header("WARC-Target-URI", uri)
            + _header("WARC-Payload-Digest", f"sha1:{digest}")
            + (_header("WARC-Profile", PROFILE) if record_type == "revisit" else "")
            + _header("X-Page-Id", page_id) + _header("X-Refers-To-Page-Id", refers_to)
            + _header("X-Payload-Length", payload_bytes)
            + f"Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body


def _rendered(packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                yield pa.RecordBatch.from_arrays([pa.array([render(
                    r["page_id"], r["uri"], r["record_type"], r["digest"], r["refers_to"],
                    zlib.decompress(r["payload"]) if packed and r["payload"] else r["payload"] or b"",
                    r["payload_bytes"]) for r in rows.to_pylist()], pa.binary())], names=["value"])
    return run


def write_archive(records: DataFrame, path: str, per_file: int = RECORDS_PER_FILE, packed: bool = False) -> None:
    """Write records (page_id, uri, record_type, digest, refers_to, payload,
    payload_bytes) as WARC files below ``path``; ``packed`` payloads are
    zlib-compressed."""
    # a text row may hold any bytes: the cast does not change them
    (records.mapInArrow(_rendered(packed), "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record; gzip members are
    opened one after the other."""
    if data[:2] == b"\x1f\x8b":
        while data[:2] == b"\x1f\x8b":
            member = zlib.decompressobj(31)
            yield from parse(member.decompress(data) + member.flush())
            data = member.unused_data
        return
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        stop = data.index(b"\r\n\r\n", at)
        head = {}
        for line in data[at:stop].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            head[name.strip().lower()] = value.strip()
        begin = stop + 4
        at = begin + int(head["content-length"])
        yield head, data[begin:at]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _parsed(with_payload: bool, packed: bool):
    schema = pa.schema(_FIELDS if with_payload else [f for f in _FIELDS if f[0] != "payload"])

    def rows(data: bytes):
        for head, block in parse(data):
            kind = head.get("warc-type")
            if kind not in ("response", "revisit"):
                continue
            digest = payload_digest(block) if kind == "response" else head.get("warc-payload-digest", "").removeprefix("sha1:")
            size = len(block) if kind == "response" else _number(head.get("x-payload-length"))
            yield (_number(head.get("x-page-id")), head.get("warc-target-uri"), kind, digest,
                   _number(head.get("x-refers-to-page-id")), *([zlib.compress(block, 1) if packed else block] if with_payload else []), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held = []
                for row in rows(content.as_buffer().to_pybytes()):
                    held.append(row)
                    if len(held) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
    return run


def read_archive(spark: SparkSession, path: str, with_payload: bool = True, packed: bool = False) -> DataFrame:
    """The response and revisit records of an archive. The digest of a
    response is computed from its payload. ``packed`` payloads come
    zlib-compressed (as they should travel through a shuffle)."""
    schema = _RECORD if with_payload else _RECORD.replace("payload binary, ", "")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
            .mapInArrow(_parsed(with_payload, packed), schema))


def page_records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", body_col: str = "html") -> DataFrame:
    """Every page as a response record."""
    body = F.encode(F.coalesce(F.col("body"), F.lit("")), "UTF-8")
    return (own_columns(pages, id_col, uri_col, body_col).toDF("page_id", "uri", "body")
            .select(F.col("page_id").cast("long").alias("page_id"), "uri", F.lit("response").alias("record_type"),
                    _base32(F.sha1(body)).alias("digest"), F.lit(None).cast("long").alias("refers_to"),
                    body.alias("payload"), F.octet_length(body).cast("long").alias("payload_bytes")))


def _base32(hex_text):
    """Base32 of a hexadecimal SHA-1: eight groups of 20 bits, four signs each."""
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    fives = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    groups = [F.lpad(F.conv(F.substring(hex_text, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), fives, signs)


def resolve(headers: DataFrame, least: int = 0) -> DataFrame:
    """``headers`` with record_type and refers_to decided anew."""
    by = headers.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("answer"))
    alone = (F.col("payload_bytes") < least) | F.col("answer").isNull() | F.col("page_id").eqNullSafe(F.col("answer"))
    return (headers.drop("record_type", "refers_to").join(by, ["digest", "payload_bytes"])
            .select("page_id", "uri", "digest", "payload_bytes",
                    F.when(alone, "response").otherwise("revisit").alias("record_type"),
                    F.when(~alone, F.col("answer")).alias("refers_to")))


def deduplicate(spark: SparkSession, source: str, target: str, least: int = 0, per_file: int = RECORDS_PER_FILE) -> None:
    """Write the archive ``source`` anew as ``target``, a payload once."""
    decided = resolve(read_archive(spark, source, with_payload=False), least)
    # records alike in page, address and digest are decided alike: one row each
    decided = decided.groupBy("page_id", "uri", "digest").agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("record_type").alias("record_type"),
        F.first("refers_to").alias("refers_to"))
    d = decided.toDF(*[f"d_{c}" for c in decided.columns])
    old = read_archive(spark, source, packed=True).drop("record_type", "refers_to", "payload_bytes")
    fresh = old.join(d, old["page_id"].eqNullSafe(F.col("d_page_id")) & old["uri"].eqNullSafe(F.col("d_uri"))
                     & (old["digest"] == F.col("d_digest")))
    write_archive(fresh.select("page_id", "uri", F.col("d_record_type").alias("record_type"), "digest",
                               F.col("d_refers_to").alias("refers_to"),
                               F.when(F.col("d_record_type") == "response", F.col("payload")).alias("payload"),
                               F.col("d_payload_bytes").alias("payload_bytes")), target, per_file, packed=True)


def archive_pages(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", body_col: str = "html",
                  least: int = 0) -> tuple[str, str]:
    """Write the pages as an archive and that archive deduplicated; the two
    folders, below the session's shared folder."""
    spark = pages.sparkSession
    raw, clean = fresh_dir(spark, "llm-warc-raw"), fresh_dir(spark, "llm-warc")
    write_archive(page_records(pages, id_col, uri_col, body_col), raw)
    deduplicate(spark, raw, clean, least)
    return raw, clean
