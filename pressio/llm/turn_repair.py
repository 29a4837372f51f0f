"""Repair of the order of turns in conversations, by weighted interval parsing.

A conversation is repaired if its role initials spell ``(s?(ua)+)?``. Rows may
be kept, given another role or deleted, and empty turns inserted; the cheapest
edits are found by CYK over spans of rows, with this grammar in Chomsky's
normal form (a kind names the first and last sign of what it derives; U and A
alternate within it)::

    start  -> empty | ua | sa
    ua -> uu aa | ua ua     uu -> uu au | ua uu | 'u'     su -> s uu | su au | sa uu
    au -> aa uu | au au     aa -> aa ua | au aa | 'a'     sa -> s ua | su aa | sa ua     s -> 's'

A cell holds, for each kind that the rows of a span can be edited into, the
least (cost, audit); the audit is the string of edits (Delete, Insert, Keep,
Rerole). Cells are closed under insertions at both ends, which are kinds that no
row stands for. Whatever a kind derives can be split anywhere into two parts
that have kinds, and the rules rebuild it from them: so one way of splitting a
span finds all its derivations, and cells are combined bottom-up in spans of
doubling length, n - 1 combinations for n rows. Audits of one span and cost
are never one another's beginning (each row has one letter, and a further
insertion costs more), so the least audit of a whole is made of least parts.

Rows are sorted by range over all conversations, so a conversation of any
length is dealt over tasks. One that lies within a partition is parsed, edited
and hashed there. Of those that cross a boundary, at most two a partition, each
partition gives the cell of its run of rows; runs are combined, the edits
dealt out to the rows again, and their text is hashed as a stream. What a
task holds of a conversation that crosses is its audit, not its text; its
SHA-256 is one stream by nature.

Rows of a turn are in order of ``role:text``. Equal rows of a turn are one row
with a number of copies, of which the first may stay. A row is a
duplicate if the conversation has its role and text at an earlier turn.

Defined cases: a NULL role or text is one space (thus a blank text, and a role
that is none of the three); a NULL turn comes first, and has no part in gaps; a NULL id
is a conversation of its own; an empty role has no initial; very long texts
are hashed, not compared, and are in a task one row at a time or with the
rows of their conversation in a partition; an empty table gives no rows. Columns beyond the named ones are ignored,
whatever they are called.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ._common import cut

WHITE = " \t\n\x0b\f\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
EMPTY = ""
RULES = [("ua", "uu", "aa"), ("ua", "ua", "ua"), ("uu", "uu", "au"), ("uu", "ua", "uu"),
         ("au", "aa", "uu"), ("au", "au", "au"), ("aa", "aa", "ua"), ("aa", "au", "aa"),
         ("su", "s", "uu"), ("su", "su", "au"), ("su", "sa", "uu"),
         ("sa", "s", "ua"), ("sa", "su", "aa"), ("sa", "sa", "ua")]
START = (EMPTY, "ua", "sa")
LEGAL = ("su", "ua", "au")
EDGE = 80                         # characters of a row that its range is chosen by
PIECES = 4096                     # rows of edits in a batch

Cell = dict[str, tuple[int, str]]

# By the left side's kind: what follows it, and what they make.
_AFTER: dict[str, list[tuple[str, str]]] = {}
for _made, _left, _right in RULES:
    _AFTER.setdefault(_left, []).append((_right, _made))


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}

    def offer(kind, a, b):
        found = (a[0] + b[0], a[1] + b[1])
        if kind not in out or found < out[kind]:
            out[kind] = found
    for kind, a in left.items():
        if kind == EMPTY:
            for other, b in right.items():
                offer(other, a, b)
            continue
        if EMPTY in right:
            offer(kind, a, right[EMPTY])
        for other, made in _AFTER.get(kind, ()):
            if other in right:
                offer(made, a, right[other])
    return out


def insertions() -> Cell:
    """The cell of no rows: what insertions alone make, until nothing gets cheaper."""
    cell: Cell = {EMPTY: (0, ""), "uu": (INSERT, "I"), "aa": (INSERT, "I")}
    while True:
        more = combine(cell, cell)
        if more == cell:
            return cell
        cell = more


def leaf(initial: str, truncated: bool, forced: bool) -> Cell:
    """The cell of one row, closed under insertions."""
    own: Cell = {EMPTY: (DELETE, "D")}
    if not forced:
        extra = TRUNCATED if truncated else 0
        own |= {"uu": (REROLE + extra, "R"), "aa": (REROLE + extra, "R")}
        kept = {"u": "uu", "a": "aa", "s": "s"}.get(initial)
        if kept:
            own[kept] = min(own.get(kept, (1 << 60, "")), (extra, "K"))
    around = insertions()
    return combine(combine(around, own), around)


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[kind] for kind in START if kind in cell)


class Run:
    """Rows of a conversation in order: their counts, and their cells in spans
    of doubling length."""

    def __init__(self):
        self.spans: list[tuple[int, Cell]] = []
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def push(self, cell: Cell, size: int = 1) -> None:
        self.spans.append((size, cell))
        while len(self.spans) > 1 and self.spans[-2][0] <= self.spans[-1][0]:
            (m, a), (n, b) = self.spans[-2:]
            self.spans[-2:] = [(m + n, combine(a, b))]

    def cell(self) -> Cell:
        spans = [c for _, c in self.spans] or [insertions()]
        while len(spans) > 1:
            spans[-2:] = [combine(*spans[-2:])]
        return spans[0]

    def follow(self, initial: str, turn, last_initial: str, last_turn, turns: int) -> None:
        """Rows that follow: what lies between them and those before."""
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        if self.first is None:
            self.first = initial
        self.last = last_initial
        if last_turn is not None:
            # the turns are sorted, so only the next can be one of those before
            self.turns += turns - (self.high is not None and turn == self.high)
            self.low = turn if self.low is None else self.low
            self.high = last_turn

    def add(self, turn, initial: str, blank: bool, cut_off: bool, first: bool, copies: int) -> None:
        self.follow(initial, turn, initial, turn, 1)
        self.illegal += copies - 1 if initial + initial not in LEGAL else 0
        alive = first and not blank
        self.rows += copies
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - alive
        self.truncated += alive and cut_off
        self.push(_leaf(initial, alive and cut_off, not alive))
        if copies > 1:
            more = copies - 1
            self.push(combine({EMPTY: (DELETE * more, "D" * more)}, insertions()))

    def gaps(self) -> int:
        return 0 if self.high is None else self.high - self.low + 1 - self.turns


_LEAVES: dict[tuple, Cell] = {}


def _leaf(initial: str, truncated: bool, forced: bool) -> Cell:
    key = (initial if initial in ("u", "a", "s") else "", truncated, forced)
    if key not in _LEAVES:
        _LEAVES[key] = leaf(*key)
    return _LEAVES[key]


def place_role(at: int, outputs: int) -> str:
    """Role of the ``at``-th of ``outputs`` repaired turns, where an edit sets it."""
    return "assistant" if (at + outputs) % 2 else "user"


def edited(letters: str, at: int, outputs: int, line: str, role_length: int) -> list[str]:
    """The repaired lines that a row and the insertions around it become."""
    lines = []
    for letter in letters:
        if letter == "D":
            continue
        if letter == "K":
            lines.append(line)
        elif letter == "R":
            lines.append(place_role(at + len(lines), outputs) + line[role_length:])
        else:
            lines.append(place_role(at + len(lines), outputs) + ":")
    return lines


def row_letters(audit: str, copies: list[int]):
    """The letters of each row: its insertions before, its own, and at the end
    those after."""
    at = 0
    for i, n in enumerate(copies):
        end = at
        while n:
            n -= audit[end] != "I"
            end += 1
        if i == len(copies) - 1:
            end = len(audit)
        yield audit[at:end]
        at = end


def outputs_of(audit: str) -> int:
    return len(audit) - audit.count("D")


# What a task says of its rows: results of conversations that lie within it
# (kind 0), runs of those that may not (1), and the rows of these (2).
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_SCANNED = ("kind int, part int, nth long, gaps long, blank long, duplicate long, truncated long, illegal long, "
            "cost long, audit string, repaired_sha256 string, lines array<string>, copies array<long>, "
            "low long, high long, turns long, first string, last string, "
            "cell array<struct<kind: string, cost: long, audit: string>>, line string, role_length int")


def _scan(keep_lines: bool, types: dict[str, pa.DataType]):
    def batch_of(kind, rows, conv_type):
        cols = [pa.array([kind if n == "kind" else r.get(n) for r in rows], t) for n, t in types.items()]
        return pa.RecordBatch.from_arrays([pa.array([r["conv"] for r in rows], conv_type), *cols], ["conv", *types])

    def result(run, held, conv):
        cost, audit = best(run.cell())
        outputs, at, lines = outputs_of(audit), 0, []
        for letters, (line, length, _) in zip(row_letters(audit, [h[2] for h in held]), held):
            made = edited(letters, at, outputs, line, length)
            at += len(made)
            lines += made
        digest = hashlib.sha256()
        for i, line in enumerate(lines):
            digest.update((b"\n" if i else b"") + line.encode("utf-8", "surrogatepass"))
        return {"conv": conv, "gaps": run.gaps(), **{c: getattr(run, c) for c in _COUNTS}, "cost": cost,
                "audit": audit, "repaired_sha256": digest.hexdigest(), "lines": lines if keep_lines else None}

    def scan(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        now, run, held, crossing, nth, conv_type = None, None, [], True, 0, None

        def pieces(rows, start):
            return [{"conv": now, "part": part, "nth": start + i, "line": r[0], "role_length": r[1],
                     "copies": [r[2]]} for i, r in enumerate(rows)]

        def summary():
            return {"conv": now, "part": part, "gaps": 0, **{c: getattr(run, c) for c in _COUNTS}, "low": run.low,
                    "high": run.high, "turns": run.turns, "first": run.first, "last": run.last,
                    "cell": [{"kind": k, "cost": c, "audit": a} for k, (c, a) in run.cell().items()]}
        for batch in batches:
            conv_type = batch.schema.field("conv").type
            results, parts = [], []
            for r in batch.to_pylist():
                if run is None or r["conv"] != now:
                    if run is not None:
                        if crossing:
                            yield batch_of(1, [summary()], conv_type)
                        else:
                            results.append(result(run, held, now))
                    # the first conversation of a partition may have begun before it
                    crossing = run is None
                    now, run, held, nth = r["conv"], Run(), [], 0
                run.add(r["at"]["turn"], r["role"][:1], r["blank"], r["cut_off"], r["first"], r["copies"])
                row = (r["line"], len(r["role"]), r["copies"])
                if crossing:
                    parts += pieces([row], nth)
                    nth += 1
                else:
                    held.append(row)
            for kind, rows in ((0, results), (2, parts)):
                if rows:
                    yield batch_of(kind, rows, conv_type)
        if run is not None:
            yield batch_of(1, [summary()], conv_type)
            if held:  # the last may go on after it
                yield batch_of(2, pieces(held, 0), conv_type)
    return scan


def _joined(batches):
    """Conversations from their runs: a row of results, and the edits of each row."""
    names = ["gaps", *_COUNTS, "cost", "audit", "part", "nth", "letters", "at", "outputs"]
    kinds = [pa.int64()] * 6 + [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        conv_type = batch.schema.field("conv").type
        for r in batch.to_pylist():
            whole = Run()
            for x in r["runs"]:
                whole.follow(x["first"], x["low"], x["last"], x["high"], x["turns"])
                for c in _COUNTS:
                    setattr(whole, c, getattr(whole, c) + x[c])
                whole.push({c["kind"]: (c["cost"], c["audit"]) for c in x["cell"]}, len(x["copies"]))
            cost, audit = best(whole.cell())
            outputs = outputs_of(audit)
            places = [(x["part"], i) for x in r["runs"] for i in range(len(x["copies"]))]
            rows, at = [(whole.gaps(), *[getattr(whole, c) for c in _COUNTS], cost, audit, *[None] * 5)], 0
            for (part, nth), letters in zip(places, row_letters(audit, [n for x in r["runs"] for n in x["copies"]])):
                rows.append((*[None] * 7, part, nth, letters, at, outputs))
                at += outputs_of(letters)
                if len(rows) == PIECES:
                    yield _columns(r["conv"], rows, conv_type, names, kinds)
                    rows = []
            if rows:
                yield _columns(r["conv"], rows, conv_type, names, kinds)


def _columns(conv, rows, conv_type, names, kinds):
    return pa.RecordBatch.from_arrays(
        [pa.array([conv] * len(rows), conv_type), *[pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]],
        ["conv", *names])


def _apply(batches):
    """The repaired lines of rows with their edits."""
    for batch in batches:
        lines = [edited(*x) for x in zip(*[batch.column(c).to_pylist() for c in (
            "letters", "at", "outputs", "line", "role_length")])]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("conv", "part", "nth", "at")], pa.array(lines, pa.list_(pa.string()))],
            ["conv", "part", "nth", "at", "lines"])


def _hashed(batches):
    """SHA-256 of each conversation's lines, as they come."""
    now, digest, any_, kind = None, None, False, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()])],
                                          ["conv", "repaired_sha256"])
    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, lines in zip(batch.column("conv").to_pylist(), batch.column("lines").to_pylist()):
            if digest is None or conv != now:
                if digest is not None:
                    yield done()
                now, digest, any_ = conv, hashlib.sha256(), False
            for line in lines:
                digest.update((b"\n" if any_ else b"") + line.encode("utf-8", "surrogatepass"))
                any_ = True
    if digest is not None:
        yield done()


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows as the contract's faults,
    chosen by a checksum of ``conv_id:turn``, leave them."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(c, space) for c in ("role", "text"))
    fault = F.col("fault")
    return (turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("fault"))
            .filter("fault <> 0").select(
                "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
                F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
                .alias("text"), F.when(fault == 3, 2).otherwise(1).cast("long").alias("copies")))


def _blank(text: Column) -> Column:
    return F.length(F.translate(text, WHITE, "")) == 0


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their faults, sorted by range over all conversations."""
    given = rows.select(
        F.struct("conv_id").alias("conv"), F.struct(F.col("turn").cast("long").alias("turn")).alias("at"), "role",
        F.concat_ws(":", "role", "text").alias("line"), _blank(F.col("text")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut_off"), "copies",
        F.xxhash64("role", "text").alias("d1"), F.xxhash64(F.lit(1), "role", "text").alias("d2"))
    merged = given.groupBy("conv", "at", "d1", "d2").agg(
        F.first("role").alias("role"), F.first("line").alias("line"), F.first("blank").alias("blank"),
        F.first("cut_off").alias("cut_off"), F.sum("copies").alias("copies"))
    # NULL turns are the least; structs of one make them equal in the join
    first = (given.select("conv", "at", "d1", "d2").groupBy("conv", "d1", "d2").agg(F.min("at").alias("at"))
             .withColumn("first", F.lit(True)))
    known = merged.join(first, ["conv", "at", "d1", "d2"], "left").select(
        "conv", "at", "role", "line", "blank", "cut_off", F.coalesce("first", F.lit(False)).alias("first"), "copies")
    return (known.repartitionByRange("conv", "at", F.substring("line", 1, EDGE))
            .sortWithinPartitions("conv", "at", "line", "role"))


def _parsed(rows: DataFrame, keep_lines: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Results of conversations in one partition; results of the others; the
    repaired lines of these, piece by piece."""
    ordered = sorted_rows(rows)
    said = StructType.fromDDL(_SCANNED)
    conv = ordered.schema["conv"]
    types = {f.name: to_arrow_type(f.dataType) for f in said.fields}
    scanned = cut(ordered.mapInArrow(_scan(keep_lines, types), StructType([conv, *said.fields])))
    inside = scanned.filter("kind = 0")
    pieces = scanned.filter("kind = 2").select(
        "conv", "part", "nth", "line", "role_length", F.col("copies")[0].alias("copies"))
    copies = pieces.groupBy("conv", "part").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("nth", "copies"))), lambda x: x["copies"]).alias("copies"))
    runs = (scanned.filter("kind = 1").drop("copies").join(copies, ["conv", "part"]).groupBy("conv")
            .agg(F.array_sort(F.collect_list(F.struct("part", "copies", *_COUNTS, "low", "high", "turns", "first",
                                                      "last", "cell"))).alias("runs")))
    joined = cut(runs.mapInArrow(_joined, StructType([conv, *StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "part int, nth long, letters string, at long, outputs long").fields])))
    edits = joined.filter("part is not null").select("conv", "part", "nth", "letters", "at", "outputs")
    made = pieces.join(edits, ["conv", "part", "nth"]).mapInArrow(_apply, StructType([
        conv, *StructType.fromDDL("part int, nth long, at long, lines array<string>").fields]))
    return inside, joined.filter("part is null"), made


def repair(rows: DataFrame) -> DataFrame:
    """What each conversation of ``rows`` (conv_id, turn, role, text, copies)
    lacks, and its cheapest repair: a row per conversation with any row."""
    inside, across, made = _parsed(rows, False)
    columns = ["conv", "gaps", *_COUNTS, "cost", "audit"]
    conv = made.schema["conv"]
    hashes = (made.repartition("conv").sortWithinPartitions("conv", "part", "nth")
              .mapInArrow(_hashed, StructType([conv, *StructType.fromDDL("repaired_sha256 string").fields])))
    return (inside.select(*columns, "repaired_sha256")
            .unionByName(across.select(*columns).join(hashes, "conv").select(*columns, "repaired_sha256"))
            .select("conv.conv_id", *columns[1:], "repaired_sha256"))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, line): the turns after repair, each as ``role:text``."""
    inside, _, made = _parsed(rows, True)
    return (inside.select("conv.conv_id", F.posexplode("lines").alias("place", "line"))
            .select("conv_id", F.col("place").cast("long").alias("place"), "line")
            .unionByName(made.select("conv.conv_id", "at", F.posexplode("lines").alias("i", "line"))
                         .select("conv_id", (F.col("at") + F.col("i")).alias("place"), "line")))


def report(turns: DataFrame, rows: DataFrame) -> DataFrame:
    """:func:`repair` of ``rows`` for every conversation of ``turns``, with
    zeros where it has no row left."""
    every = turns.select(F.struct("conv_id").alias("conv")).distinct()
    found = repair(rows).withColumn("conv", F.struct("conv_id")).drop("conv_id")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_COUNTS, "cost")]
    return every.join(found, "conv", "left").select(
        "conv.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
