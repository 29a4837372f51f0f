"""What each filter of a chain removes, in every order of the chain.

Five filters judge whole texts: A too few words, B too few distinct words,
C too many capitals, D signs of markup, E a text that an earlier document
has. A and B are decided by a sparse document-term matrix (:func:`term_matrix`):

1. texts are taken in shards of about ``SHARD`` bytes; each becomes the rows
   of a CSR matrix over the shard's own words, which are listed once, in the
   order of a hash;
2. the lists of all shards are dealt by that hash, packed by shard, and numbered
   0, 1, .. (the dictionary: numbered within partitions of about ``PART`` bytes
   of words, whose sizes give the offsets);
3. each shard gets the numbers of its words back, packed by partition, and its
   columns are renamed by them: CSR shards over one vocabulary.

A row's sum is the document's number of words, its stored entries are the
distinct ones. The remaining flags are attached to the rows, and documents are
counted by (part, pattern of failed filters, labels): of these few counts
every step of all 120 orders follows, so no document is looked at per order.

A word is in the shuffle once a shard that holds it, however often it occurs.
The first document of a text is found by a partial minimum per text, and rows
meet it by (text, doc_id): the copies of a hot text are spread over their ids.
A shard holds whole rows; a text beyond ``SHARD`` is a shard of its own.

Defined cases: a NULL text is an empty one (it fails A alone of A to D: 0 distinct
of 0 words are no shortage); a NULL part counts with the empty one; a NULL id
is no earlier than any and has none before it, nor labels; rows that repeat
(doc_id, text) are none before the other and all counted; several label rows
of an id count as one that has what any of them has; an empty table gives no
rows. Columns beyond the named ones are ignored, whatever they are called.
"""

from __future__ import annotations

import string
from functools import partial, reduce
from itertools import permutations
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from ._common import chunks, cut, drop_folder, setting, shared_folder, text_bytes

SHARD = 1 << 23
PIECE = 1 << 20                   # bytes of a shard whose words are held one by one at once
PACK = 1 << 18                    # words numbered at once at least
PART = 1 << 24                    # bytes of words that a partition numbers
TEXTS = 1 << 10                   # texts handed over at once
ROWS_A_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES_A_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
MARKUP = "#$%&*|"


def _lists(values, offsets=None) -> pa.Array:
    """One list of all values, as a column of one row."""
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _entries(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """CSR rows of texts, and the words that are their columns."""
    split = pa.compute.ascii_split_whitespace(pa.compute.fill_null(text, ""))
    lengths = np.asarray(pa.compute.list_value_length(split))
    words = split.flatten()
    real = pa.compute.greater(pa.compute.binary_length(words), 0)
    row = np.repeat(np.arange(len(text)), lengths)[np.asarray(real)]
    coded = words.filter(real).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    n = max(1, len(coded.dictionary))
    entries, counts = np.unique(row * n + np.asarray(coded.indices, np.int64), return_counts=True)
    ends = np.searchsorted(entries, np.arange(len(text) + 1) * n)
    return (ends.astype(np.int32), (entries % n).astype(np.int32), counts.astype(np.int32),
            coded.dictionary.cast(pa.binary()))


def _joined(pieces: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The CSR rows of all pieces over one list of their words."""
    ends, columns, counts, words = zip(*pieces)
    coded = pa.concat_arrays(words).dictionary_encode()
    at = np.cumsum([0, *map(len, words)])
    named = np.asarray(coded.indices)[np.concatenate([c + i for c, i in zip(columns, at)])]
    begins = np.cumsum([0, *map(len, columns)])
    return (np.concatenate([[0], *[e[1:] + i for e, i in zip(ends, begins)]]).astype(np.int32),
            named.astype(np.int32), np.concatenate(counts), coded.dictionary)


def _raw(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words back to back, and the size of each."""
    off = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1] if len(words) else [0]
    data = words.buffers()[2] if len(words) else None
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], np.diff(off).astype(np.int32)


def _words(raw, sizes: np.ndarray) -> pa.Array:
    """The words that :func:`_raw` took apart."""
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def _hashes(raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """32 bits of each word's bytes."""
    if not len(sizes):
        return np.zeros(0, np.uint64)
    begins = np.cumsum(sizes, dtype=np.int64) - sizes
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(raw)) - np.repeat(begins, sizes)
    sums = np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * powers[place], begins)
    sums = (sums ^ (sums >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (sums ^ (sums >> np.uint64(29))) >> np.uint64(32)


def _local_shards(batches, more: dict, limit: int, piece: int):
    """CSR rows of each ``limit`` bytes of texts over their own words, which are in
    the order of their hashes; numbers and words packed in bytes."""
    from pyspark import TaskContext

    part, nth, held, size = TaskContext.get().partitionId(), 0, [], 0

    def packed():
        ends, columns, counts, words = _joined([entries for _, entries in held])
        order = np.argsort(_hashes(*_raw(words)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        raw, sizes = _raw(words.take(pa.array(order)))
        rows = pa.concat_arrays([rows for rows, _ in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + nth]), _lists(rows),
             *[pa.array([x.tobytes()]) for x in (ends, place[columns], counts, raw, sizes)]],
            ["shard", "rows", "ends", "columns", "counts", "words", "sizes"])
    for batch in batches:
        for lo, hi in chunks(batch, "text", min(piece, limit)):
            rows, text = (batch.column(c).slice(lo, hi - lo) for c in ("row", "text"))
            made = {name: pa.array(of(text), pa.int64()) for name, of in more.items()}
            names = [f.name for f in rows.type]
            held.append((pa.StructArray.from_arrays([*rows.flatten(), *made.values()], [*names, *made]), _entries(text)))
            # a row without words takes room, too
            size += sum(pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy()) + 16 * len(text)
            if size >= limit:
                yield packed()
                nth, held, size = nth + 1, [], 0
    if held:
        yield packed()


def _dealt(batches, parts: int):
    """(part, shard, at, words, sizes): the words of a shard from the ``at``-th on whose
    hashes are those of a part."""
    for batch in batches:
        for i in range(batch.num_rows):
            raw, sizes = _unpacked(batch, i, "words", np.uint8), _unpacked(batch, i, "sizes")
            part = (_hashes(raw, sizes) * np.uint64(parts)) >> np.uint64(32)
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)] if len(part) else [0]
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            spans = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(part[lo]) for lo, _ in spans], pa.int32()),
                 pa.array([batch.column("shard")[i].as_py()] * len(spans), pa.int64()),
                 pa.array([lo for lo, _ in spans], pa.int32()),
                 pa.array([raw[ends[lo]:ends[hi]].tobytes() for lo, hi in spans], pa.binary()),
                 pa.array([sizes[lo:hi].tobytes() for lo, hi in spans], pa.binary())],
                ["part", "shard", "at", "words", "sizes"])


def _unpacked(batch: pa.RecordBatch, i: int, column: str, kind=np.int32) -> np.ndarray:
    return np.frombuffer(batch.column(column)[i].as_buffer(), kind)


def _numbered(batches, pack: int):
    """Numbers of words, from 0 in each partition: (shard, at, ids) of a shard's words from
    the ``at``-th on, and the words in the order of their numbers (``first``, words, sizes)."""
    from pyspark import TaskContext

    part, known, held, n = TaskContext.get().partitionId(), pa.array([], pa.binary()), [], 0

    def rows(shards, ats, ids, first, words, sizes):
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(shards), pa.int32()), pa.array(shards, pa.int64()), pa.array(ats, pa.int32()),
             pa.array(ids, pa.binary()), pa.array(first, pa.int64()), pa.array(words, pa.binary()),
             pa.array(sizes, pa.binary())], ["part", "shard", "at", "ids", "first", "words", "sizes"])

    def named():
        # words keep the number of their first place: those known before come first
        shards, ats, words = zip(*held)
        coded = pa.concat_arrays([known, *words]).dictionary_encode()
        ids = np.asarray(coded.indices, np.int32)[len(known):]
        cuts = np.cumsum([0, *map(len, words)])
        nothing = [None] * len(shards)
        return coded.dictionary, rows(shards, ats, [ids[i:j].tobytes() for i, j in zip(cuts, cuts[1:])],
                                      nothing, nothing, nothing)
    for batch in batches:
        for i in range(batch.num_rows):
            words = _words(batch.column("words")[i].as_py(), _unpacked(batch, i, "sizes"))
            held.append((batch.column("shard")[i].as_py(), batch.column("at")[i].as_py(), words))
            n += len(words)
            # as many as are known at least, so that these are not met too often
            if n >= max(pack, len(known)):
                known, found = named()
                yield found
                held, n = [], 0
    if held:
        known, found = named()
        yield found
    for i in range(0, len(known), pack):
        raw, sizes = _raw(known.slice(i, pack))
        yield rows([None], [None], [None], [i], [raw.tobytes()], [sizes.tobytes()])


def _listed(batches):
    """(word, id) of packed words, numbered from ``first`` on."""
    for batch in batches:
        for i in range(batch.num_rows):
            words = _words(batch.column("words")[i].as_py(), _unpacked(batch, i, "sizes"))
            first = batch.column("first")[i].as_py()
            yield pa.RecordBatch.from_arrays([words, pa.array(np.arange(first, first + len(words)))], ["word", "id"])


def _renamed(batches):
    """Shards with the columns that the dictionary gives, in their order."""
    for batch in batches:
        for i in range(batch.num_rows):
            ends, columns, counts = (_unpacked(batch, i, c) for c in ("ends", "columns", "counts"))
            pieces = batch.column("pieces")[i].as_py() or []
            ids = np.zeros(sum(len(x["ids"]) for x in pieces) // 4, np.int64)
            for x in pieces:
                some = np.frombuffer(x["ids"], np.int32)
                ids[x["at"]:x["at"] + len(some)] = some + x["shift"]
            named = ids[columns]
            span = int(ids.max()) + 1 if len(ids) else 1
            # entries are in the order of their rows
            order = np.argsort(np.repeat(np.arange(len(ends) - 1), np.diff(ends)) * span + named)
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard").slice(i, 1), batch.column("rows").slice(i, 1), _lists(ends),
                 _lists(named[order]), _lists(counts[order])], ["shard", "rows", "ends", "columns", "counts"])


def _sums(batches):
    """The sum and the number of stored entries of each row of the shards."""
    for batch in batches:
        for i in range(batch.num_rows):
            ends, counts = (np.asarray(batch.column(c)[i].values, np.int64) for c in ("ends", "counts"))
            total = np.concatenate([[0], np.cumsum(counts)])[ends]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rows")[i].values, pa.array(np.diff(total)), pa.array(np.diff(ends))],
                ["row", "n_words", "n_distinct"])


def _kind(row: StructType) -> StructType:
    def many(x):
        return ArrayType(x, False)
    return StructType([StructField("shard", LongType()), StructField("rows", ArrayType(row)),
                       StructField("ends", many(IntegerType())), StructField("columns", many(LongType())),
                       StructField("counts", many(IntegerType()))])


def term_matrix(docs: DataFrame, text: str = "text", more: dict | None = None) -> tuple[DataFrame, DataFrame, str]:
    """CSR shards, dictionary and the folder that holds what they are made of.

    Shards: (shard, rows, ends, columns, counts); row i of a shard is that of
    ``rows[i]`` (all columns of ``docs`` but ``text``, and as longs those that the
    functions ``more`` make of an array of texts), with columns and counts
    from ``ends[i]`` up to ``ends[i + 1]``, columns ascending.
    """
    spark, more = docs.sparkSession, more or {}
    rest = [c for c in docs.columns if c != text]
    given = docs.select(F.struct(*rest).alias("row"), F.col(text).alias("text"))
    row = StructType([*given.schema["row"].dataType.fields, *[StructField(name, LongType()) for name in more]])
    path = shared_folder(spark, "term-shards")
    packed = [StructField(c, BinaryType()) for c in ("ends", "columns", "counts", "words", "sizes")]
    with setting(spark, ROWS_A_BATCH, str(TEXTS)), setting(spark, BYTES_A_BATCH, str(PIECE)):
        given.mapInArrow(partial(_local_shards, more=more, limit=SHARD, piece=PIECE), StructType(
            [StructField("shard", LongType()), StructField("rows", ArrayType(row)), *packed])
        ).write.option("compression", "zstd").parquet(path)
    local = spark.read.parquet(path)
    # each task has words of a bounded size, by their hashes
    size = local.agg(F.sum(F.octet_length("words") + F.octet_length("sizes"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART))
    with setting(spark, ROWS_A_BATCH, "1"):
        listed = local.select("shard", "words", "sizes").mapInArrow(
            partial(_dealt, parts=parts), "part int, shard long, at int, words binary, sizes binary")
        numbered = cut(listed.repartitionById(parts, F.col("part")).sortWithinPartitions("shard", "at").mapInArrow(
            partial(_numbered, pack=PACK),
            "part int, shard long, at int, ids binary, first long, words binary, sizes binary"))
    new = numbered.filter("shard is null").select("part", "first", "words", "sizes")
    shifts, total = [], 0
    for r in new.groupBy("part").agg(F.sum(F.expr("octet_length(sizes) div 4")).alias("n")).orderBy("part").collect():
        shifts.append((r["part"], total))
        total += r["n"]
    # one row a partition
    shift = F.broadcast(spark.createDataFrame(shifts, "part int, shift long"))
    dictionary = new.join(shift, "part").select(
        (F.col("first") + F.col("shift")).alias("first"), "words", "sizes").mapInArrow(_listed, "word binary, id long")
    names = (numbered.filter("shard is not null").join(shift, "part").groupBy("shard")
             .agg(F.collect_list(F.struct("at", "ids", "shift")).alias("pieces")))
    shards = local.drop("words", "sizes").join(names, "shard", "left").mapInArrow(_renamed, _kind(row))
    return shards, dictionary, path


def row_sums(shards: DataFrame) -> DataFrame:
    """(row, n_words, n_distinct) of every row of CSR shards."""
    row = shards.schema["rows"].dataType.elementType
    return shards.select("rows", "ends", "counts").mapInArrow(_sums, StructType([
        StructField("row", row), StructField("n_words", LongType()), StructField("n_distinct", LongType())]))


def _signs(text: pa.Array) -> np.ndarray:
    """The bits C and D of each text's failed filters."""
    raw, off = text_bytes(text)
    kinds = np.zeros(256, np.uint8)
    kinds[[ord(c) for c in string.ascii_uppercase]], kinds[[ord(c) for c in MARKUP]] = 1, 2
    found = kinds[raw]
    capitals, marks = (np.diff(np.searchsorted(np.flatnonzero(found == kind), off)) for kind in (1, 2))
    length = np.asarray(pa.compute.fill_null(pa.compute.utf8_length(text), 0), np.int64)
    return (_of("C") * (100 * capitals > MOST_CAPITALS * length) + _of("D") * (marks > 0)).astype(np.int64)


def _of(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def _bit(failed: Column, letter: str) -> Column:
    return F.when(failed, F.lit(_of(letter))).otherwise(F.lit(0))


def failed_filters(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, failed, n): how many rows of an id and part fail just
    the filters whose bits (A: 1, B: 2, ..) are set in ``failed``."""
    t = F.coalesce(text, F.lit(""))
    given = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2"), t.alias("text"))
    shards, _, path = term_matrix(given, more={"cd": _signs})
    a = F.col("n_words") < LEAST_WORDS
    b = 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words")
    sums = (row_sums(shards).select("row.*", (F.col("row.cd") + _bit(a, "A") + _bit(b, "B")).cast("int").alias("abcd"))
            .groupBy("doc_id", "part", "t1", "t2", "abcd").agg(F.count(F.lit(1)).alias("n")))
    with setting(docs.sparkSession, ROWS_A_BATCH, "1"):
        rows = cut(sums)
    drop_folder(docs.sparkSession, path)
    first = (rows.groupBy("t1", "t2").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null")
             .withColumn("first", F.lit(True)))
    # a row is the first of its text where its id is the smallest; one without an id has none before it
    late = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["t1", "t2", "doc_id"], "left").select(
        "doc_id", "part", (F.col("abcd") + _bit(late, "E")).alias("failed"), "n")


def patterns(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             part: str = "source") -> DataFrame:
    """(part, failed, n, good, toxic): rows by the filters they fail, and how
    many of them are labelled good and toxic."""
    marks = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))

    def of(mark):
        return F.sum(F.col("n") * F.coalesce(mark, F.lit(0))).alias(mark)
    return (failed_filters(docs, key, text, part).join(marks, "doc_id", "left").groupBy("part", "failed")
            .agg(F.sum("n").alias("n"), of("good"), of("toxic")))


def audit(counts: DataFrame) -> DataFrame:
    """Every step of every order of the filters, from :func:`patterns`."""
    every = 1 << len(FILTERS)
    n, failed = F.col("n"), F.col("failed")
    # what passes each set of filters: 32 rows a pattern at most, one map a part
    sets = counts.select("part", "n", "good", "toxic", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(every - 1)), lambda s: s.bitwiseAND(failed) == 0)).alias("passed"))
    passing = (sets.groupBy("part", "passed").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
               .groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(
                   "passed", F.struct("n", "good", "toxic")))).alias("left")))

    def over(value):
        return F.array(*[F.coalesce(F.sum(F.when(failed.bitwiseAND(F.lit(1 << f)) != 0, value(f))), F.lit(0))
                         .cast("long") for f in range(len(FILTERS))])
    orders = len(list(permutations(FILTERS)))
    # of the filters that a row fails, each is the first in as many orders as any other
    share = reduce(add, [F.when(F.bit_count(failed) == k, n * (orders // k)).otherwise(0)
                         for k in range(1, len(FILTERS) + 1)])
    own = counts.groupBy("part").agg(
        over(lambda f: n).alias("fails"), over(lambda f: F.when(failed == (1 << f), n)).alias("alone"),
        over(lambda f: share).alias("shares"))
    listed = ",".join(map("".join, permutations(FILTERS)))
    each = (passing.join(own, "part")
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(orders * len(FILTERS) - 1))).alias("q"))
            .select("*", F.get(F.split(F.lit(listed), ","), F.expr(f"cast(q div {len(FILTERS)} as int)")).alias("filter_order"),
                    (F.col("q") % len(FILTERS) + 1).alias("step"))
            .withColumn("f", F.expr(f"instr('{FILTERS}', substring(filter_order, step, 1)) - 1"))
            .withColumn("before", reduce(add, [F.when(F.instr("filter_order", x) < F.col("step"), 1 << f).otherwise(0)
                                               for f, x in enumerate(FILTERS)]))
            .withColumn("after", F.expr("before + shiftleft(1, f)")))

    def left(bits, name):
        return F.coalesce(F.try_element_at("left", bits)[name], F.lit(0))

    def gone(name):
        return left(F.col("before"), name) - left(F.col("after"), name)
    return each.select(
        "part", "filter_order", "step", left(F.col("after"), "n").alias("kept"), gone("n").alias("removed"),
        (F.get("fails", F.col("f")) - gone("n")).alias("redundant"), F.get("alone", F.col("f")).alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), F.get("shares", F.col("f")).alias("shapley"))
