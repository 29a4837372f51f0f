import base64
import gzip
import hashlib
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from pressio.llm import oracles, queries, warc

ROWS = [(1, "http://a/", "<p>é</p>"), (2, "http://b/\r\nX: 1", "<p>é</p>"), (3, None, None),
        (4, "http://c/", ""), (5, "http://d/", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        (6, "http://e/", "x" * 3_000_000), (7, "http://f/", "<p>é</p>"), (8, "http://g/", "y" * 10)]


def expected(rows):
    body = {i: (html or "").encode() for i, _, html in rows}
    top = {}
    for i, b in body.items():
        top[b] = max(top.get(b, i), i)
    return {i: (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                "response" if top[b] == i else "revisit", None if top[b] == i else top[b])
            for i, b in body.items()}


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn(
        "payload", F.lit("clash")).withColumn("record_id", F.lit(1)).repartition(3)
    src, dst, again = (tempfile.mkdtemp(prefix="warc-") + "/x" for _ in range(3))
    warc.write_archives(warc.page_records(pages), src, records_per_file=2)
    order = warc.page_id_of(F.col("record_id"))
    warc.deduplicate_archives(spark, src, dst, order, records_per_file=2)
    rows = {int(r.record_id.split(":")[-1]): r for r in warc.read_archives(spark, dst).collect()}
    want = expected(ROWS)
    assert set(rows) == set(want)
    for i, (size, digest, kind, refers) in want.items():
        r = rows[i]
        assert (r.declared_bytes, r.payload_digest, r.record_type) == (size, digest, kind)
        assert r.refers_to_id == (f"urn:page:{refers}" if refers else None)
        html = dict((a, c) for a, _, c in ROWS)[i]
        assert bytes(r.payload) == ((html or "").encode() if kind == "response" else b"")
    assert rows[3].target_uri is None and rows[2].target_uri == "http://b/ X: 1"
    # archives that hold revisits already stay as they are
    warc.deduplicate_archives(spark, dst, again, order)
    same = {int(r.record_id.split(":")[-1]): r for r in warc.read_archives(spark, again).collect()}
    assert same == rows


def test_revisit_without_its_original(spark):
    heads = spark.createDataFrame(
        [("a", "revisit", "D1", 1), ("b", "response", None, 2), ("c", "response", "D2", 3),
         ("d", "response", "D2", 3)],
        "record_id string, record_type string, payload_digest string, order_key long")
    got = {r.record_id: r.original_id for r in warc.resolve_revisits(heads).collect()}
    assert got == {"a": None, "b": None, "c": "d", "d": "d"}


def record(i, payload, kind="response"):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{i}>\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def test_archives_of_other_writers(spark):
    """A gzip member per record, several records a member, no compression, any suffix."""
    d = tempfile.mkdtemp(prefix="warc-")
    body = {i: os.urandom(40_000_000 if i == 3 else i * 50) + b"\r\n\r\nWARC/1.0\r\n" for i in range(1300)}
    parts = {"members.warc.gz": range(700), "plain.warc": range(700, 800), "odd.bin": range(800, 1300)}
    for name, ids in parts.items():
        with open(os.path.join(d, name), "wb") as fh:
            for i in ids:
                one = record(i, body[i])
                fh.write(gzip.compress(one, 1) if name != "plain.warc" else one)
    open(os.path.join(d, "empty.warc"), "wb").close()
    got = {r.record_id: (r.declared_bytes, r.payload_digest) for r in warc.read_archives(spark, d).drop("payload").collect()}
    assert got == {f"urn:x:{i}": (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()) for i, b in body.items()}


@pytest.mark.parametrize("keep", [30, -10])
def test_cut_archives_are_refused(spark, keep):
    whole = record(1, b"a" * 100) + record(2, b"b" * 100)
    for blob in (whole[:keep], gzip.compress(whole)[:keep]):
        with pytest.raises((ValueError, KeyError, EOFError)):
            list(warc.parse_archive(blob))


def test_empty_table(spark):
    src, dst = (tempfile.mkdtemp(prefix="warc-") + "/x" for _ in range(2))
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(warc.page_records(none), src)
    warc.deduplicate_archives(spark, src, dst, F.col("record_id"))
    assert warc.read_archives(spark, dst).collect() == []


def test_base32_is_the_libraries(spark):
    r = spark.createDataFrame([(b"",), (b"abc",)], "p binary").select(
        "p", warc.base32_sha1(F.col("p")).alias("d")).collect()
    assert all(x.d == base64.b32encode(hashlib.sha1(bytes(x.p)).digest()).decode() for x in r)


def test_query_equals_sql(spark, tables):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tables}/pages.parquet')")
    rel = con.execute(oracles.OP2)
    cols = [d[0] for d in rel.description]
    want = {dict(zip(cols, r))["page_id"]: dict(zip(cols, r)) for r in rel.fetchall()}
    got = queries.op2_warc_revisit(spark, tables).collect()
    assert len(got) == len(want) and all(want[r.page_id] == r.asDict() for r in got)


def test_pages_that_share_an_id(spark):
    """Each record is decided by its own payload, and is one record."""
    rows = [(1, "u", "a"), (1, "u", "b"), (2, "u", "a"), (3, "u", "c"), (3, "u", "c"), (0, "u", "b")]
    src, dst = (tempfile.mkdtemp(prefix="warc-") + "/x" for _ in range(2))
    warc.write_archives(warc.page_records(spark.createDataFrame(rows, "page_id long, url string, html string")), src)
    warc.deduplicate_archives(spark, src, dst, warc.page_id_of(F.col("record_id")))
    digest = {base64.b32encode(hashlib.sha1(x.encode()).digest()).decode(): x for x in "abc"}
    got = sorted((int(r.record_id[9:]), digest[r.payload_digest], r.record_type, r.refers_to_id or "",
                  bytes(r.payload).decode()) for r in warc.read_archives(spark, dst).collect())
    assert got == [(0, "b", "revisit", "urn:page:1", ""), (1, "a", "revisit", "urn:page:2", ""),
                   (1, "b", "response", "", "b"), (2, "a", "response", "", "a"),
                   (3, "c", "response", "", "c"), (3, "c", "response", "", "c")]
