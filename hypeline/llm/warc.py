"""WARC archives and revisit resolution.

``write_archive`` writes one record per payload, ``read_archive`` parses
archives, also those of other writers, and ``dedupe_archive`` rewrites an
archive so that of equal payloads only the record that comes first stays a
response and the others become revisits of it.  Headers (digest, id, length)
are shuffled by payload digest and joined; the first record per digest and one
copy of the payload are pre-aggregated in each task, so a payload held by a
third of all pages is one row per task and is written once.

Payloads are bytes throughout, in any encoding.  Records are written by Spark's
text writer, so any store Spark can write holds archives: it writes the bytes
of a value as they are, and its line separator is the last of the two line ends
that close a record.  Files are gzip-compressed as a whole and hold at most
``RECORDS_PER_FILE`` records.  They are read as whole compressed files,
decompressed and parsed as a stream, and cut by ``Content-Length``, so a payload
may contain anything, WARC headers included; a task holds one compressed file,
one record and one batch.  Digest and length of a response are computed from
the bytes read, not taken from its headers.

Record ids are text.  A page's record is ``urn:page:<page_id>:<hash>``, unique
also if page_ids repeat; ids of other writers (``urn:uuid:...``) are kept and
have no page_id.  First is the smallest page_id (null last), then the smallest
record id and url.  A block of ``application/http`` is an HTTP head, kept as it
is, and the payload after it.  Records of other types (warcinfo, request,
metadata) are carried through a rewrite with their type, id, date and block.

Null and empty cases: a null payload is written as an empty one and is equal
to it; equal payloads are those of equal SHA-1 and length; payloads shorter
than ``min_bytes`` are never revisits; repeated page_ids with equal payloads
give one response and revisits that refer to that id; a null page_id sorts
last and is read back as null; an empty table writes an archive without
records; a record that ends before its ``Content-Length``, or has none, raises.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypeline.llm.common import bounded_batches, field
from hypeline.session import scratch_path

MIN_BYTES = 0
RECORDS_PER_FILE = 10_000
BATCH_BYTES = 4 << 20
EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"   # fixed by the WARC standard
ID_PREFIX = "urn:page:"
DATE = "1970-01-01T00:00:00Z"    # of records that bring no date; the caller may give another
CONTENT_TYPE = "text/html"

RECORD = ("record_id string, page_id long, record_type string, url string, date string, content_type string, "
          "payload_digest string, refers_to_id string, refers_to long, content_length long, head binary, payload binary")
_FIELDS = ["url", "date", "content_type", "head"]     # carried from a record to its rewritten form


def sha1_base32(data: Column) -> Column:
    """Base32 SHA-1: each five hex digits (20 bits) are four base-32 digits."""
    hexes = F.sha1(data)
    four = [F.lpad(F.conv(F.substring(hexes, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*four), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def header_rows(pages: DataFrame, payload: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """A record per page: text payloads as UTF-8, binary ones as they are."""
    data = F.coalesce(field(payload).cast("binary"), F.lit("").cast("binary"))
    text = F.lit(None).cast("string")
    return pages.select(text.alias("record_id"), field(key).cast("long").alias("page_id"),
                        field(url).cast("string").alias("url"), text.alias("date"), text.alias("content_type"),
                        F.lit(None).cast("binary").alias("head"), data.alias("payload"),
                        F.octet_length(data).cast("long").alias("payload_bytes"),
                        sha1_base32(data).alias("payload_digest"))


def _named(rows: DataFrame, *parts: str) -> DataFrame:
    """Rows with a record id: their own, or one made of the page_id and a hash."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("url", "payload_digest", *parts)]
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    made = F.concat(F.lit(ID_PREFIX), page, F.lit(":"), F.md5(F.concat_ws("\n", *values)))
    return rows.withColumn("record_id", F.coalesce("record_id", made))


def deduplicate(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The records to write for ``rows`` (columns of ``header_rows``): of equal
    payloads of at least ``min_bytes``, the first row is a response and every
    other one a revisit without payload."""
    same = ["payload_digest", "payload_bytes"]
    row = ["record_id", "page_id", *_FIELDS]
    place = F.struct(F.col("page_id").isNull().alias("last"), "page_id", F.col("record_id").isNull().alias("made"),
                     "record_id", "url", "date", "content_type", "head")
    small, rest = rows.where(F.col("payload_bytes") < min_bytes), rows.where(F.col("payload_bytes") >= min_bytes)
    # Each payload is shuffled once per task that holds it, whatever the number of its pages.
    responses = rest.groupBy(*same).agg(F.min(place).alias("f"), F.first("payload").alias("payload"))
    # Repeated rows are counted per part of the input, so no count is expanded beyond the rows of a part.
    headers = rest.groupBy(*row, *same, F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    firsts = (headers.groupBy(*same).agg(F.min(F.struct(place.alias("f"), "part")).alias("first"), F.sum("n").alias("all"))
              .where(F.col("all") > 1))
    # One of the rows that equal the first is the response itself.
    left = F.col("n") - F.when(F.struct(place.alias("f"), "part") == F.col("first"), 1).otherwise(0)
    revisits = (headers.join(firsts, same).withColumn("n", left).where("n > 0")
                .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))))
    target = _named(revisits.select(*[F.col(f"first.f.{c}").alias(c) for c in ("record_id", "page_id", "url")],
                                    "payload_digest", F.struct(*revisits.columns).alias("own")))
    target = target.select("own.*", F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    no_target = [F.lit(None).cast("string").alias("refers_to_id"), F.lit(None).cast("long").alias("refers_to")]
    kind = lambda k: F.lit(k).alias("record_type")
    again = _named(target, "part", "i").select(*row, F.lit("").cast("binary").alias("payload"), *same,
                                               kind("revisit"), "refers_to_id", "refers_to")
    first = _named(responses.select("f.*", "payload", *same)).select(*row, "payload", *same, kind("response"), *no_target)
    # Small payloads are not grouped: rows that repeat get their own ids by their place in the input.
    alone = small.withColumn("i", F.monotonically_increasing_id())
    return first.unionByName(again).unionByName(
        _named(alone, "i").select(*row, "payload", *same, kind("response"), *no_target))


def _record(date: str) -> Column:
    """The bytes of one record without its last line end, from marked rows."""
    revisit = F.col("record_type") == "revisit"
    line = lambda name, c: F.concat(F.lit(f"{name}: "), F.regexp_replace(c, r"[\r\n]", ""), F.lit(EOL))
    uri = lambda c: F.concat(F.lit("<"), F.col(c), F.lit(">"))
    none = F.lit("")
    payload = F.when(revisit, none).otherwise(F.coalesce(F.col("payload").cast("string"), none))
    head = F.coalesce(F.col("head").cast("string"), none)
    return F.concat(
        F.lit("WARC/1.1" + EOL), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", uri("record_id")),
        F.coalesce(line("WARC-Target-URI", F.col("url")), none),
        line("WARC-Date", F.coalesce("date", F.lit(date))),
        F.coalesce(line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))), none),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                 F.coalesce(line("WARC-Refers-To", uri("refers_to_id")), none))).otherwise(none),
        line("Content-Type", F.coalesce("content_type", F.lit(CONTENT_TYPE))),
        line("Content-Length", (F.octet_length(head) + F.octet_length(payload)).cast("string")),
        F.lit(EOL), head, payload, F.lit(EOL))


def write_archive(rows: DataFrame, path: str, date: str = DATE, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write marked rows as WARC files.  Payloads were dealt out by digest when
    they were deduplicated, in partitions that adaptive execution sizes, and are
    written from there without another shuffle."""
    (rows.select(_record(date).alias("value")).write.option("lineSep", EOL).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of one uncompressed archive stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = headers.get("content-length", "")
        if not size.isdigit():
            raise ValueError(f"record {headers.get('warc-record-id')} has no Content-Length")
        block = stream.read(int(size))
        if len(block) < int(size):
            raise ValueError(f"record {headers.get('warc-record-id')} ends after {len(block)} of {size} bytes")
        yield headers, block


def open_archive(data: bytes | pa.Buffer) -> BinaryIO:
    """A stream over an archive file, whether it is compressed as a whole, record by record, or not at all."""
    raw = pa.BufferReader(data)
    packed = raw.read(2) == b"\x1f\x8b"
    raw.seek(0)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, 1 << 16)


def _id(uri: str | None) -> str | None:
    return uri.strip("<>") if uri else None


def _page(record_id: str | None) -> int | None:
    """The page_id in an id of this module, none in others."""
    own = re.match(re.escape(ID_PREFIX) + r"(-?\d+):", record_id or "")
    return int(own[1]) if own else None


def _split(headers: dict[str, str], block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (empty if the block is none) and payload."""
    if headers.get("content-type", "").lower().startswith("application/http"):
        stop = block.find(b"\r\n\r\n")
        return (block, b"") if stop < 0 else (block[:stop + 4], block[stop + 4:])
    return b"", block


def _row(headers: dict[str, str], block: bytes, payload: bool) -> dict:
    kind, own, other = headers.get("warc-type"), _id(headers.get("warc-record-id")), _id(headers.get("warc-refers-to"))
    head, data = _split(headers, block)
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind != "revisit":
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
    return {"record_id": own, "page_id": _page(own), "record_type": kind, "url": headers.get("warc-target-uri"),
            "date": headers.get("warc-date"), "content_type": headers.get("content-type"), "payload_digest": digest,
            "refers_to_id": other, "refers_to": _page(other), "content_length": len(data),
            "head": head if payload else None, "payload": data if payload else None}


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all files below ``path``; ``content_length`` is that of the
    payload, ``head`` and ``payload`` are null if not asked for."""
    def run(batches):
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in RECORD.split(", "))])
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in parse_records(open_archive(content.as_buffer())):
                    rows.append(_row(headers, block, payload))
                    size += len(block) if payload else 0
                    if len(rows) == 500 or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    bounded_batches(spark, BATCH_BYTES)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc}").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Page_id, payload_bytes, payload_digest, record_type and refers_to of every
    response and revisit; a revisit gets the size of the response with its digest.
    Only headers are shuffled, and responses are grouped to one row per digest,
    so the join neither multiplies nor skews on the build side."""
    sizes = (records.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("__d"))
             .agg(F.max("content_length").alias("__bytes")))
    met = (records.where(F.col("record_type").isin("response", "revisit"))
           .join(sizes, F.col("payload_digest") == F.col("__d"), "left"))
    size = F.when(F.col("record_type") == "response", F.col("content_length")).otherwise(F.col("__bytes"))
    return met.select("page_id", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to",
                      "record_id", "refers_to_id")


def dedupe_archive(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES,
                   date: str = DATE) -> None:
    """Rewrite an archive: responses with a payload of an earlier one become
    revisits, and revisits already there are pointed at the remaining response
    (at their old one if the archive does not hold their payload)."""
    records = read_archive(spark, source).withColumn("payload_bytes", F.col("content_length"))
    old = records.where("record_type = 'response'")
    kept = deduplicate(old.drop("record_type", "refers_to", "refers_to_id", "content_length"), min_bytes)
    place = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "record_id")
    firsts = old.groupBy(F.col("payload_digest").alias("__d")).agg(F.min(place).alias("__first"))
    met = records.where("record_type = 'revisit'").join(firsts, F.col("payload_digest") == F.col("__d"), "left")
    found = F.col("__first").isNotNull()
    again = met.select(*[c for c in kept.columns if c not in ("refers_to", "refers_to_id")],
                       F.when(found, F.col("__first.record_id")).otherwise(F.col("refers_to_id")).alias("refers_to_id"),
                       F.when(found, F.col("__first.page_id")).otherwise(F.col("refers_to")).alias("refers_to"))
    others = records.where("record_type IS NULL OR record_type NOT IN ('response', 'revisit')").select(*kept.columns)
    write_archive(kept.unionByName(again).unionByName(others), target, date)


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES, date: str = DATE) -> DataFrame:
    """Write the pages as a deduplicated archive, read it back and resolve it."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archive(deduplicate(header_rows(pages), min_bytes), path, date)
    return resolve_revisits(read_archive(spark, path, payload=False)).drop("record_id", "refers_to_id")


__all__ = ["sha1_base32", "header_rows", "deduplicate", "write_archive", "parse_records", "open_archive", "read_archive",
           "resolve_revisits", "dedupe_archive", "archive_pages"]
