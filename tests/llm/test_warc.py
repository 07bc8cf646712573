import base64
import gzip
import hashlib
import pathlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hypeline.llm import warc

from .cases import SF, nothing

DDL = "page_id long, url string, html string, payload string, n int"
PAGES = [(3, "http://a", "same page"), (1, "http://b", "same page"), (2, None, "same page"), (4, "http://c", None),
         (5, "http://d", ""), (6, "http://e", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\n"),
         (7, "http://f\r\nX: y", "ünï\x00 \r\n\r\n tail\r\n"), (8, "http://g", "x" * 300_000), (9, "http://h", "one"),
         (9, "http://h", "one"), (None, "http://i", "one"), (None, "http://j", "lone page")]


def expected(rows, min_bytes=0):
    groups, out = {}, []
    for i, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    for body, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        ids.sort(key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            first = k == 0 or len(body) < min_bytes
            out.append((i, len(body), digest, "response" if first else "revisit", None if first else ids[0]))
    return Counter(out)


def pages(spark):
    return spark.createDataFrame([(*p, "clash", 1) for p in PAGES], DDL)


def test_round_trip_of_awkward_pages(spark):
    got = Counter(map(tuple, warc.archive_pages(pages(spark)).collect()))
    assert got == expected([(p[0], p[2]) for p in PAGES])
    got = Counter(map(tuple, warc.archive_pages(pages(spark), min_bytes=5).collect()))
    assert got == expected([(p[0], p[2]) for p in PAGES], 5)


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    got = Counter(map(tuple, warc.archive_pages(table).collect()))
    assert got == expected([(r.page_id, r.html) for r in table.collect()])


def test_payloads_survive(spark, scratch):
    path = scratch("warc")
    warc.write_archive(warc.deduplicate(warc.header_rows(pages(spark))), path)
    back = {r.payload for r in warc.read_archive(spark, path).where("record_type = 'response'").collect()}
    assert back == {(p[2] or "").encode() for p in PAGES}


def test_rewriting_an_archive_points_revisits_at_the_smallest_id(spark, scratch):
    old, new = scratch("old"), scratch("new")
    # All pages as responses, as a crawler without deduplication writes them.
    warc.write_archive(warc.deduplicate(warc.header_rows(pages(spark)), min_bytes=1 << 40), old)
    warc.dedupe_archive(spark, old, new)
    got = Counter(r[:5] for r in warc.resolve_revisits(warc.read_archive(spark, new)).collect())
    assert got == expected([(p[0], p[2]) for p in PAGES])
    again = scratch("again")
    warc.dedupe_archive(spark, new, again)
    assert Counter(r[:5] for r in warc.resolve_revisits(warc.read_archive(spark, again)).collect()) == got


def foreign(spark, path):
    """An archive as other writers make them: uuid ids, http blocks, one gzip member per record, other record types."""
    def record(kind, i, block, *lines):
        head = [f"WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{i:032x}>", "WARC-Date: 2020-02-02T00:00:00Z",
                *lines, f"Content-Length: {len(block)}"]
        return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    kind = "Content-Type: application/http; msgtype=response"
    latin, raw = "caf\xe9 na\xefve".encode("latin-1"), bytes(range(256)) * 40
    digest = "WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(latin).digest()).decode()
    parts = [record("warcinfo", 1, b"software: x\r\n", "Content-Type: application/warc-fields"),
             record("response", 3, http + latin, kind, "WARC-Target-URI: http://b", "WARC-Payload-Digest: sha1:WRONG"),
             record("response", 2, http + latin, kind, "WARC-Target-URI: http://a"),
             record("request", 4, b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http; msgtype=request"),
             record("response", 5, raw, "WARC-Target-URI: http://c"),
             record("revisit", 6, b"", digest, "WARC-Refers-To: <urn:uuid:00>")]
    pathlib.Path(path).mkdir(parents=True)
    (pathlib.Path(path) / "crawl.warc.gz").write_bytes(b"".join(parts))
    return latin, raw, http


def test_archives_of_other_writers(spark, scratch):
    old, new = scratch("foreign"), scratch("rewritten")
    latin, raw, http = foreign(spark, old.removeprefix("file:"))
    sha = lambda data: base64.b32encode(hashlib.sha1(data).digest()).decode()
    uuid = lambda i: f"urn:uuid:{i:032x}"
    before = {r.record_id: r for r in warc.read_archive(spark, old).collect()}
    assert before[uuid(3)].payload_digest == sha(latin) and before[uuid(3)].page_id is None
    warc.dedupe_archive(spark, old, new)
    got = {r.record_id: r for r in warc.read_archive(spark, new).collect()}
    assert {i: r.record_type for i, r in got.items()} == {
        uuid(1): "warcinfo", uuid(2): "response", uuid(3): "revisit", uuid(4): "request", uuid(5): "response", uuid(6): "revisit"}
    assert got[uuid(2)].payload == latin and got[uuid(2)].head == http and got[uuid(5)].payload == raw
    assert got[uuid(4)].head + got[uuid(4)].payload == b"GET / HTTP/1.1\r\n\r\n" and got[uuid(1)].payload == b"software: x\r\n"
    assert {i: r.refers_to_id for i, r in got.items() if r.record_type == "revisit"} == {uuid(3): uuid(2), uuid(6): uuid(2)}
    assert all(r.date == "2020-02-02T00:00:00Z" for r in got.values())
    resolved = {r.record_id: r for r in warc.resolve_revisits(warc.read_archive(spark, new, payload=False)).collect()}
    assert {i: (r.payload_bytes, r.payload_digest) for i, r in resolved.items()} == {
        uuid(2): (len(latin), sha(latin)), uuid(3): (len(latin), sha(latin)), uuid(5): (len(raw), sha(raw)), uuid(6): (len(latin), sha(latin))}


def test_binary_payloads_and_unique_record_ids(spark, scratch):
    path, body = scratch("binary"), "p\xe9".encode("latin-1") + bytes(range(256))
    rows = spark.createDataFrame([(1, "u", bytearray(body)), (1, "u", bytearray(body)), (1, "v", bytearray(b"\xff"))],
                                 "page_id long, url string, html binary")
    warc.write_archive(warc.deduplicate(warc.header_rows(rows)), path)
    back = warc.read_archive(spark, path).collect()
    assert sorted(r.payload for r in back) == sorted([b"", body, b"\xff"])
    assert len({r.record_id for r in back}) == 3 and {r.page_id for r in back} == {1}


def test_one_row_in_a_third_of_the_table(spark):
    rows = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("page_id"), F.lit("u").alias("url"),
                                     F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("html"))
    got = warc.archive_pages(rows)
    assert got.groupBy("page_id").count().where("count > 1").collect() == [(-1, 3_000)]
    assert got.where("record_type = 'revisit' AND refers_to = -1").count() == 2_999


def test_damaged_archives_raise():
    ok = b"WARC/1.0\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [b for _, b in warc.parse_records(warc.open_archive(ok * 2))] == [b"ab"] * 2
    for bad in (ok[:-6] + b"", b"WARC/1.0\r\n\r\nab", b"<html>"):
        with pytest.raises(ValueError):
            list(warc.parse_records(warc.open_archive(bad)))


def test_empty(spark):
    empty = nothing(spark).select(F.lit(1).cast("long").alias("page_id"), F.lit("u").alias("url"), F.lit("h").alias("html"))
    assert warc.archive_pages(empty).count() == 0
