"""Reading the feeds and writing the result and the published files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, IntegralType, NumericType, StringType,
                               StructField, StructType, TimestampType)

from ..functions import as_col, number_text, rejected_day


def conformed_cell(name: str, kind: DataType, strict: bool = True) -> Column:
    """A feed's text cell as its declared type.

    Empty text, quoted or not, and ``NA`` are missing. A whole number may be
    spelled ``1234``, ``1234.0`` or ``1e5``; text that is no number becomes
    NULL (the row is kept); a number with a fraction in an integer column
    fails the job, as no integer stands for it (without ``strict`` it becomes NULL).
    """
    c = as_col(name)
    trimmed = F.trim(c)
    given = F.when(~trimmed.isin("", "NA"), trimmed)
    if isinstance(kind, StringType):
        return F.when(given.isNotNull(), c)
    if isinstance(kind, IntegralType):
        refused = (F.raise_error(F.concat(F.lit(f"{name}: not a whole number: "), given)) if strict
                   else F.lit(None)).cast(kind)

        def whole(d):
            ok = ~F.isnan(d) & (F.abs(d) < F.lit(float(2 ** 63)))
            return F.when(ok & (d != F.floor(d)), refused).when(ok, d.try_cast("long").try_cast(kind))
        # text that is no number is costly to try: once a cell
        return F.coalesce(given.try_cast(kind), F.get(F.transform(F.array(given.try_cast("double")), whole), F.lit(0)))
    return given.try_cast(kind)


def _csv(spark: SparkSession, paths):
    # a header that differs from the one the columns were taken from fails
    return (spark.read.option("header", True).option("enforceSchema", False)
            .option("encoding", "UTF-8").option("inferSchema", False).csv(paths))


def _csv_records(spark: SparkSession, paths, header, record: str) -> DataFrame:
    """Files of one header, with the text of each record of more or fewer
    cells than the header in ``record`` (cells cannot be skipped for that)."""
    kinds = StructType([StructField(n, StringType()) for n in [*header, record]])
    return (spark.read.option("header", True).option("enforceSchema", False)
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", record).schema(kinds).csv(paths))


def _by_header(spark: SparkSession, files) -> dict[tuple, list]:
    """The files of each header. Their first lines are found in one pass over
    all of them; only one file of each first line is looked at by itself."""
    lines = (spark.read.text(files).select("value", F.input_file_name().alias("file"),
                                           F.col("_metadata.file_block_start").alias("start"),
                                           F.monotonically_increasing_id().alias("at"))
             # as the reader has it, the header is the first line that is not blank
             .filter((F.col("start") == 0) & (F.trim("value") != "")))
    first = lines.groupBy("file").agg(F.min("at").alias("at"))
    found = {r["file"]: r["value"] for r in lines.join(F.broadcast(first), ["file", "at"]).collect()}
    alike: dict[str, list] = {}
    for f in files:                   # a file without a line is looked at by itself
        alike.setdefault(found.get(f, f"\n{f}"), []).append(f)
    groups: dict[tuple, list] = {}
    for members in alike.values():
        groups.setdefault(tuple(_csv(spark, members[0]).columns), []).extend(members)
    return groups


def _csv_by_name(spark: SparkSession, path, names, record: str | None = None) -> DataFrame:
    """The named columns of every CSV file under ``path``, wherever each
    file has them. Files with one header are one scan; a feed of one file,
    the usual case, costs no look at the others' headers (:func:`_by_header`). ``record``: as
    :func:`_csv_records` has it."""
    df = _csv(spark, path)
    files = df.inputFiles()
    groups: dict[tuple, list] = {tuple(df.columns): files}
    if len(files) > 1:
        groups = _by_header(spark, files)
    parts = []
    for header, members in groups.items():
        missing = [n for n in names if n not in header]
        if missing:
            raise ValueError(f"{members[0] if members else path}: missing columns {missing}")
        one = (_csv_records(spark, members, header, record) if record
               else df if len(groups) == 1 else _csv(spark, members))
        parts.append(one.select(*[as_col(n) for n in [*names, *([record] if record else [])]]))
    return reduce(DataFrame.unionByName, parts)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read a landed feed (S1-S4) with a declared schema.

    CSV: header row, UTF-8, columns taken by name file by file, cells as
    :func:`conformed_cell` has it. Parquet: the declared columns are selected
    and cast, so a source with extra columns or wider types is conformed at
    the scan (pruning applies).
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        if schema is None:
            return _csv(spark, path)
        df = _csv_by_name(spark, path, schema.names)
        return df.select(*[conformed_cell(f.name, f.dataType).alias(f.name) for f in schema.fields])
    df = spark.read.format(fmt).load(path)
    if schema is None:
        return df
    native = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        keep = (isinstance(f.dataType, StringType)
                and isinstance(native.get(f.name), (DateType, TimestampType)))
        # a typed day stays typed (its filters reach the scan); the
        # pipeline parses only text days
        cols.append(as_col(f.name) if keep else as_col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)


REJECTED = "rejected"
RECORD = "(record)"               # the ledger's name of a record that does not fit its header


def read_with_rejects(spark: SparkSession, path, schema: StructType, days: Sequence[str] = (),
                      fmt: str = "csv", out: str = REJECTED) -> DataFrame:
    """A landed feed as :func:`read_table` reads it, with a ledger in each row.

    ``out`` maps the name of each column whose cell is given but cannot be
    read as its type to the cell's text; the cell itself is NULL, also where
    an integer column has a fraction. Text columns in ``days`` must hold a
    day; what does not is in the ledger and stays in its column. A CSV
    record of more or fewer cells than its header has only NULL cells and is
    in the ledger whole, under ``RECORD``. A row without rejects has an empty
    map. One pass; nothing is dropped. An empty file gives no rows.
    """
    if out in schema.names:
        raise ValueError(f"{out} is a column of the feed")
    if fmt == "csv":
        record = out
        while record in schema.names or record == out:
            record += "_"
        df = _csv_by_name(spark, path, schema.names, record)
        whole = as_col(record)
    else:
        df, whole = spark.read.format(fmt).load(path), F.lit(None).cast("string")
    # a cell is read once (_0, _1, ..), beside its text and whether it is bad
    read, judged, ledger = [], [], [F.struct(F.lit(RECORD).alias("name"), F.col("whole").alias("text"))]
    for i, f in enumerate(schema.fields):
        native = df.schema[f.name].dataType
        good = (conformed_cell(f.name, f.dataType, strict=False) if isinstance(native, StringType)
                else as_col(f.name).try_cast(f.dataType))
        read += [as_col(f.name).cast("string").alias(f"_{i}_text"), good.alias(f"_{i}")]
        bad = rejected_day(f"_{i}") if f.name in days else F.col(f"_{i}").isNull()
        judged.append(F.coalesce(bad, F.lit(False)).alias(f"_{i}_bad"))
        raw = F.col(f"_{i}_text")
        given = raw.isNotNull() & ~F.trim(raw).isin("", "NA")
        ledger.append(F.struct(F.lit(f.name).alias("name"),
                               F.when(F.col("whole").isNull() & given & F.col(f"_{i}_bad"), raw).alias("text")))
    cells = [F.when(F.col("whole").isNull(), F.col(f"_{i}")).alias(f.name) for i, f in enumerate(schema.fields)]
    df = df.select(whole.alias("whole"), *read).select("*", *judged)
    rejects = F.map_from_entries(F.filter(F.array(*ledger), lambda x: x["text"].isNotNull()))
    return df.select(*cells, rejects.alias(out))


def reject_counts(df: DataFrame, columns: Sequence[str], out: str = REJECTED) -> DataFrame:
    """(column, n_rows, n_rejected) of each of ``columns`` and of ``RECORD``, zeros
    included, over rows with a ledger; none for an empty table. A row counts
    partially before the shuffle, which holds a line per column and task."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.map_contains_key(as_col(out), c).alias("bad"))
                     for c in [*columns, RECORD]])
    return (df.select(F.explode(each).alias("x")).groupBy(F.col("x.column").alias("column"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("x.bad")).alias("n_rejected")))


def observe_rejects(df: DataFrame, columns: Sequence[str], out: str = REJECTED) -> tuple[DataFrame, Observation]:
    """``df`` without its ledger, and the counts of rejects by column of the
    first action on it, gathered in that same pass. A task that is run again
    may be counted again: a figure for a warning; :func:`reject_counts` is exact."""
    seen = Observation()
    counted = df.observe(seen, *[F.count_if(F.map_contains_key(as_col(out), c)).alias(c)
                                 for c in [*columns, RECORD]])
    return counted.drop(out), seen


MONTH = "month"


def write_result(df: DataFrame, path: str, date_col: str = "data") -> None:
    """Write the full result once (S5): one folder per month, rows sorted by
    day inside each file.

    Rows are rebalanced by month: adaptive execution splits a month that is
    larger than the advisory partition size over several tasks and files and
    joins small ones. The day order gives each Parquet row group a narrow
    day range that a day filter skips on its statistics. The whole target is
    overwritten: a rerun replaces it.
    """
    (df.withColumn(MONTH, F.date_format(as_col(date_col), "yyyy-MM"))
     .hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, as_col(date_col))
     .write.mode("overwrite").partitionBy(MONTH).parquet(path))


def months(lo, hi) -> list[str]:
    """The ``yyyy-MM`` partitions covering the days ``lo`` to ``hi``."""
    out, y, m = [], lo.year, lo.month
    while (y, m) <= (hi.year, hi.month):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def read_result(spark: SparkSession, path: str, only_months=None) -> DataFrame:
    """Read the written result back; ``only_months`` prunes the month folders."""
    df = spark.read.parquet(path)
    if only_months is not None:
        df = df.filter(F.col(MONTH).isin(list(only_months)))
    return df.drop(MONTH)


def publish_frame(df: DataFrame) -> DataFrame:
    """Numbers as published text (S7): ``10`` not ``10.0``, no exponent.

    A row's doubles are formatted as one array, so that the expression is
    in the plan once, whatever the number of columns.
    """
    reals = [f.name for f in df.schema.fields
             if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, IntegralType)]
    if reals:
        texts = F.transform(F.array(*[as_col(c).cast("double") for c in reals]), lambda x: number_text(x))
        df = df.select(F.struct(*[as_col(c) for c in df.columns]).alias("row"), texts.alias("texts"))
    out = []
    for f in df.schema["row"].dataType.fields if reals else df.schema.fields:
        c = F.col("row")[f.name] if reals else as_col(f.name)
        if f.name in reals:
            c = F.get("texts", F.lit(reals.index(f.name)))
        elif isinstance(f.dataType, NumericType):
            c = number_text(c, True)
        out.append(c.cast("string").alias(f.name))
    return df.select(*out)


def publish_csv(df: DataFrame, path: str, order_by=None) -> None:
    """Write a published CSV (S6): header, ``NA`` for NULL, rows in order.

    A sort by range: the part files, read in the order of their names, are
    the table in its order. A small table is one file, as adaptive execution
    joins its ranges; one that grows with the entities is several.
    """
    out = df.orderBy(*order_by) if order_by is not None else df.hint("rebalance")
    (publish_frame(out).write.mode("overwrite").option("header", True)
     .option("nullValue", "NA").option("emptyValue", "")
     .option("encoding", "UTF-8").csv(path))
