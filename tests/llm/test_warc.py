import base64
import hashlib

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from streamgauge.llm.common import scratch
from streamgauge.llm.warc import parse_records, read_archive, verified_pages, write_archive

PAGES = [(1, "http://a/é", "<p>ü\r\n\r\nx</p>"), (2, None, "<p>ü\r\n\r\nx</p>"), (3, "http://b", None), (4, "http://b\r\nEvil: 1", ""), (5, "u", "solo" * 5000), (2, None, "<p>ü\r\n\r\nx</p>"), (None, "n", "nobody"), (None, "n", "solo" * 5000)]
SCHEMA = "page_id long, url string, html string, key string, owner string, payload string, n string, digest string"


def table(spark, rows):
    return spark.createDataFrame([(*r, *"?????") for r in rows], SCHEMA)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark):
    path = scratch(spark, "warc_test")
    write_archive(table(spark, PAGES), path)
    raw = {bytes(r.record) for r in read_archive(spark, path).collect()}
    assert any(r.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and r.endswith("<p>ü\r\n\r\nx</p>\r\n\r\n".encode()) for r in raw)
    bodies = {bytes(r.payload) for r in parse_records(read_archive(spark, path)).filter("record_type = 'response'").collect()}
    assert bodies == {(h or "").encode() for _, _, h in PAGES}
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    got = sorted((tuple(r) for r in verified_pages(spark, path).collect()), key=str)
    biggest = {"<p>ü\r\n\r\nx</p>": 2, "": 4, "solo" * 5000: 5}
    want = []
    for page_id, _, html in PAGES:
        h = html or ""
        owner = biggest.get(h)
        first = owner is None or page_id == owner
        want.append((page_id, len(h.encode()), digest(h), "response" if first else "revisit", None if first else owner))
    assert got == sorted(want, key=str)


HOSTILE = [
    "http://a/\u2028WARC-Payload-Digest: sha1:AAAA", "http://a/\x85WARC-Type: revisit", "x\r\nWARC-Type: revisit\r\nWARC-Refers-To: <urn:page:1>", "y\r\n\r\nbody", "\n", "\r", "100%0A",
    "50%25\n%0D", "a\rb", "WARC-Type: revisit", "", "\x0bz", "u\r\nX-Target-Escaped: yes", "http://p/%41?q=%",
]


def test_no_url_changes_another_field_and_all_come_back(spark):
    path = scratch(spark, "warc_test")
    write_archive(table(spark, [(i, url, f"body {i % 5}") for i, url in enumerate(HOSTILE)]), path)
    parsed = {r.page_id: r for r in parse_records(read_archive(spark, path)).collect()}
    assert {i: r.url for i, r in parsed.items()} == dict(enumerate(HOSTILE))
    for r in verified_pages(spark, path).collect():
        owner = max(i for i in range(len(HOSTILE)) if i % 5 == r.page_id % 5)
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == owner else ("revisit", owner))
        assert r.payload_digest == digest(f"body {r.page_id % 5}") and r.payload_bytes == 6


def test_changed_bytes_are_an_error(spark):
    path, other = scratch(spark, "warc_test"), scratch(spark, "warc_test")
    write_archive(table(spark, PAGES), path)
    payloads = spark.read.parquet(f"{path}/payloads")
    payloads.withColumn("payload", F.when(F.octet_length("payload") > 1000, F.lit(b"other")).otherwise(F.col("payload"))).write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    for read in (verified_pages, read_archive):
        with pytest.raises((PySparkException, Py4JJavaError), match="differs from its key"):
            read(spark, other).collect()


def test_small_payloads_are_responses(spark):
    path = scratch(spark, "warc_test")
    write_archive(table(spark, PAGES[:4]), path, least=5)
    assert {(r.page_id, r.record_type) for r in verified_pages(spark, path).collect()} == {(1, "revisit"), (2, "response"), (3, "response"), (4, "response")}


def test_empty(spark):
    path = scratch(spark, "warc_test")
    write_archive(table(spark, []), path)
    assert verified_pages(spark, path).count() == 0
