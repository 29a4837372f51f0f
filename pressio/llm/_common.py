"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# White space as the contracts define it: space, tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
PACK = 1 << 18                    # short rows of a packed partition at most


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Within, the session has ``key`` set to ``value``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_go(spark: SparkSession):
    """Within, the shuffle files of an action go when it ends, not when the
    driver's garbage happens to be collected. For actions whose result is
    stored: a frame acted on again shuffles again."""
    return setting(spark, SHUFFLES_GO, "true")


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder (reliable, survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_go(df.sparkSession):
        # a frame goes by the settings that it was made under
        return df.select("*").checkpoint(eager=True)


def packed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored frame of short rows in no more partitions than hold ``PACK`` rows
    each: the many that a shuffle left, most of them all but empty, cost their
    readers a task each. Up to ``PACK`` rows are one partition, which
    groups and joins with its like need not shuffle."""
    if rows is None:
        # counted by as many tasks as run at once
        rows = df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism)).count()
    return df.coalesce(parts(rows))


def parts(rows: int) -> int:
    """How many partitions of ``PACK`` short rows hold ``rows``."""
    return max(1, -(-rows // PACK))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the session's checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def word_count(text):
    """Number of words, 0 for NULL; JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chunks(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts hold about ``limit`` bytes each; a
    longer text is a range of its own."""
    col = batch.column(column)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0))
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array back to back, and the n + 1 offsets (a
    NULL has no bytes)."""
    col = pa.compute.fill_null(col, "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)
    off = off[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if not len(off):
        off = np.zeros(1, np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]
