"""WARC archives: write, read back, and resolve repeated payloads to revisits.

A record is a header block, an empty line and the payload bytes, followed by
two line ends. Spark's text writer stores exactly that when its line
separator is those two line ends, so archives are written by Spark's own
committers on any store and hold arbitrary payload bytes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format (ISO 28500).
VERSION = "WARC/1.1"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = ("record_id string, target_uri string, record_type string, "
                 "payload_digest string, refers_to_id string, declared_bytes long, payload binary")
# Bounds of a batch that a reader hands on.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20
HEADER_SCHEMA = ("record_id string, target_uri string, record_type string, "
                 "payload_digest string, refers_to_id string, declared_bytes long")


def base32_sha1(payload):
    """Bare upper-case base32 of the SHA-1 of a binary column, JVM-side: each
    40 bits of the digest are 10 hexadecimal or 8 base-32 digits."""
    h = F.sha1(payload)
    part = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*part), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value):
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))) \
        .otherwise(F.lit(""))


def write_archives(records: DataFrame, path: str, records_per_file: int = 2000,
                   date: str = "2000-01-01T00:00:00Z") -> None:
    """Write (record_id, target_uri, record_type, payload_digest,
    refers_to_id, declared_bytes, payload) as gzip-compressed archives.

    The headers are made here, from the columns: nothing of an older header
    block is carried over. A revisit has no payload but keeps the digest and
    length of what it stands for, and the id it refers to. A line end in a URI becomes a space (a
    header line cannot hold one); a NULL URI leaves its line out; a NULL
    payload is written as empty. ``records_per_file`` bounds an archive.
    """
    revisit = F.col("record_type") == "revisit"
    payload = F.when(revisit, F.lit("").cast("binary")) \
        .otherwise(F.coalesce("payload", F.lit("").cast("binary")))
    uri = F.regexp_replace("target_uri", r"[\r\n]+", " ")
    head = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_id"), F.lit(">"))),
        _line("X-Payload-Length", F.col("declared_bytes").cast("string")),
        F.lit("Content-Type: text/html" + CRLF),
        _line("Content-Length", F.octet_length(payload).cast("string")), F.lit(CRLF))
    (records.select(F.concat(F.encode(head, "UTF-8"), payload).cast("string").alias("value"))
     .write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, payload) of each record of an archive,
    plain or gzipped in any number of members, unpacked as it is read.
    Content-Length decides where a payload ends, so it may hold anything."""
    raw = io.BytesIO(data)
    stream = gzip.GzipFile(fileobj=raw) if data[:2] == b"\x1f\x8b" else raw
    while line := stream.readline():
        if not line.strip():                  # what ends the record before
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k.strip().lower()] = v.strip()
        size = int(head["content-length"])
        payload = stream.read(size)
        if len(payload) < size:
            raise ValueError(f"archive ends within record {head.get('warc-record-id')}")
        yield head, payload


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of every archive under ``path``; ``payloads=False`` leaves
    the payload column out, so that what is shuffled later are headers only.

    A response's digest is computed from its payload and must equal the
    header's, else the job fails. Every file under ``path`` is an archive,
    whatever its suffix, but for those whose names begin with ``_`` or ``.``. In
    memory at a time are one archive as it is stored and the records of one
    batch, bounded in rows and bytes; a longer payload is a batch of its own.
    """
    schema = RECORD_SCHEMA if payloads else HEADER_SCHEMA

    def parse(batches):
        for batch in batches:
            for raw in batch.column("content"):
                rows, held = [], 0
                for head, payload in parse_archive(raw.as_py()):
                    kind = head.get("warc-type")
                    stated = (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    if kind == "response":
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if stated not in (None, found):
                            raise ValueError(f"payload digest differs in {head.get('warc-record-id')}")
                        stated, size = found, len(payload)
                    else:
                        size = int(head.get("x-payload-length") or 0)
                    row = (_bare(head.get("warc-record-id")), head.get("warc-target-uri"), kind,
                           stated, _bare(head.get("warc-refers-to")), size)
                    rows.append(row + (payload,) if payloads else row)
                    held += len(payload) if payloads else 0
                    if len(rows) == BATCH_ROWS or held >= BATCH_BYTES:
                        yield _batch(rows, payloads)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, payloads)

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("content"))
    return files.mapInArrow(parse, schema)


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    names = ["record_id", "target_uri", "record_type", "payload_digest", "refers_to_id",
             "declared_bytes"] + ["payload"] * payloads
    kinds = [pa.string()] * 5 + [pa.int64()] + [pa.binary()] * payloads
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)], names=names)


def resolve_revisits(headers: DataFrame, order: str = "order_key") -> DataFrame:
    """Add ``original_id``: the record that holds the payload of each digest.

    Of the responses with one digest, that with the largest ``order`` is the
    original. Digests are aggregated before they are shuffled, so a payload
    that a third of all records share costs one row per task, and the join
    back is one that Spark splits when a digest is hot. A revisit without
    any response of its digest gets a NULL original; a NULL digest matches
    nothing.
    """
    best = (headers.filter("record_type = 'response' and payload_digest is not null")
            .groupBy("payload_digest")
            .agg(F.max(F.struct(F.col(order), F.col("record_id"))).alias("_o")))
    return (headers.join(best, "payload_digest", "left")
            .withColumn("original_id", F.col("_o.record_id")).drop("_o"))


def deduplicate_archives(spark: SparkSession, src: str, dst: str, order,
                         records_per_file: int = 2000) -> None:
    """Read the archives under ``src`` and write them anew under ``dst`` with
    each payload once: its original stays a response, every other record of
    the digest becomes (or stays) a revisit that refers to it, with fresh
    headers and a fresh record id. ``order`` is a column expression over a
    record's headers; the record with the largest value is the original.

    Only headers are shuffled by digest. The decisions then meet the records
    by record id and digest, so records that share an id are each decided by
    their own payload; responses equal in both stay as they are, both the
    original. A revisit whose original is in none of the archives keeps
    its reference. Empty archives give empty archives.
    """
    heads = read_archives(spark, src, payloads=False).withColumn("order_key", order)
    decided = resolve_revisits(heads).select(
        F.col("record_id").alias("_id"), F.col("payload_digest").alias("_digest"), "original_id").distinct()
    met = (F.col("record_id") == F.col("_id")) & F.col("payload_digest").eqNullSafe(F.col("_digest"))
    keep = (F.col("record_type") == "response") & F.col("original_id").eqNullSafe(F.col("record_id"))
    kind = F.when(keep, F.lit("response")) \
        .when(F.col("original_id").isNotNull(), F.lit("revisit")).otherwise(F.col("record_type"))
    out = (read_archives(spark, src).join(decided, met)
           .withColumn("refers_to_id", F.when(keep, F.lit(None).cast("string"))
                       .otherwise(F.coalesce("original_id", "refers_to_id")))
           .withColumn("record_type", kind)
           .withColumn("payload", F.when(F.col("record_type") == "response", F.col("payload"))))
    write_archives(out, dst, records_per_file)


def page_records(pages: DataFrame) -> DataFrame:
    """One response record per page; the record id carries the page id, a
    NULL html is an empty payload. Pages that share an id share the record id
    and are told apart by their payload's digest; a NULL page id makes a NULL
    record id, which no archive takes back. Other columns of ``pages`` are ignored."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit("").cast("binary"))
    return pages.select(
        F.concat(F.lit("urn:page:"), F.col("page_id").cast("string")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit("response").alias("record_type"),
        base32_sha1(payload).alias("payload_digest"),
        F.lit(None).cast("string").alias("refers_to_id"),
        F.octet_length(payload).cast("long").alias("declared_bytes"), payload.alias("payload"))


def page_id_of(record_id):
    """The page id in a record id, as a number."""
    return F.regexp_extract(record_id, r"^urn:page:(-?\d+)$", 1).try_cast("long")


