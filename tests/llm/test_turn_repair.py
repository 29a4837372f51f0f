"""Repair of turns against edits tried one state at a time, and by hand."""

import hashlib
import itertools
import random
import zlib

import pytest

from pressio.llm import turn_repair
from pressio.llm.turn_repair import best, combine, edited, insertions, leaf, outputs_of, row_letters

KIND = "conv_id long, turn long, role string, text string"
ENDS = ("user", "assistant")


def legal(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return (initials == "" or rest != "") and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2)


def every_edit(rows, most):
    """(cost, audit, output initials) of all edits with up to ``most`` insertions at a place."""
    gaps = [[(3 * k, "I" * k, "".join(c)) for k in range(most + 1) for c in itertools.product("ua", repeat=k)]] * (len(rows) + 1)
    own = []
    for initial, cut_off, forced in rows:
        extra = 3 if cut_off else 0
        own.append([(4, "D", "")] + ([] if forced else [(extra, "K", initial or "?"), (3 + extra, "R", "u"),
                                                        (3 + extra, "R", "a")]))
    parts = [gaps[0]] + [x for pair in zip(own, gaps[1:]) for x in pair]
    for choice in itertools.product(*parts):
        yield sum(c[0] for c in choice), "".join(c[1] for c in choice), "".join(c[2] for c in choice)


@pytest.mark.parametrize("seed", range(40))
def test_cells_hold_the_cheapest_least_edits(seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("uuaasx") if rnd.random() < 0.95 else "", rnd.random() < 0.3, rnd.random() < 0.2)
            for _ in range(rnd.randint(0, 3))]
    expected = min((c, a) for c, a, out in every_edit(rows, 2) if legal(out))
    cells = [leaf(*r) for r in rows] or [insertions()]
    for way in range(3):  # any way of splitting
        left = list(cells)
        while len(left) > 1:
            i = rnd.randrange(len(left) - 1) if way else len(left) - 2
            left[i:i + 2] = [combine(left[i], left[i + 1])]
        assert best(left[0]) == expected


def states(rows):
    """The cheapest, least edits, row by row through the states of the order."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserted(now):
        now = dict(now)
        for _ in range(3):
            for s, (c, a) in list(now.items()):
                for sign in "ua":
                    if (s, sign) in step:
                        t = step[s, sign]
                        now[t] = min(now.get(t, (10**9, "")), (c + 3, a + "I"))
        return now
    now = inserted({0: (0, "")})
    for initial, cut_off, forced in rows:
        nxt = {}
        for s, (c, a) in now.items():
            found = [(s, c + 4, "D")]
            if not forced:
                extra = 3 if cut_off else 0
                found += [(step[s, x], c + 3 + extra, "R") for x in "ua" if (s, x) in step]
                if (s, initial) in step:
                    found.append((step[s, initial], c + extra, "K"))
            for t, cost, letter in found:
                nxt[t] = min(nxt.get(t, (10**9, "")), (cost, a + letter))
        now = inserted(nxt)
    return min(now[s] for s in (0, 3) if s in now)


def plain(turns):
    out = {}
    for conv in {r[0] for r in turns}:
        rows = []
        for _, turn, role, text in [r for r in turns if r[0] == conv]:
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            h = zlib.crc32(key.encode()) % 20
            text = "" if h == 1 else text.translate(str.maketrans("", "", ".!?")) if h == 2 else text
            rows += [] if h == 0 else [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}:{r[2]}", r[1]))
        turns_ = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns_) - min(turns_) + 1 - len(set(turns_)) if turns_ else 0
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.strip(" \t\n\x0b\f\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = states([(r[1][:1], f == "truncated", f in ("blank", "duplicate")) for r, f in zip(rows, faults)])
        outs, lines, left = outputs_of(audit), [], iter(rows)
        for letter in audit:
            role = ("user", "assistant")[(len(lines) + outs) % 2]
            if letter == "I":
                lines.append(role + ":")
                continue
            row = next(left)
            if letter != "D":
                lines.append((row[1] if letter == "K" else role) + ":" + row[2])
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines
    return out


def made(rnd, convs, most):
    texts = ["Hello there.", "No end", "", " \t", "What?", None, "So!  ", "x: y.", "Ünï."]
    roles = ["user", "assistant", "system", None, "", "tool", "unknown", "a"]
    rows = []
    for conv in convs:
        for turn in range(rnd.randint(1, most)):
            role = rnd.choice(roles) if rnd.random() < 0.3 else ENDS[turn % 2]
            text = rnd.choice(texts) if rnd.random() < 0.4 else f"Turn {turn} of it."
            row = (conv, turn if rnd.random() < 0.9 else rnd.choice([None, 3, 40]), role, text)
            rows += [row] * (rnd.randint(2, 4) if rnd.random() < 0.1 else 1)
    return rows


def report(df):
    got = turn_repair.report(df, turn_repair.damaged(df)).collect()
    return {r["conv_id"]: tuple(r)[1:] for r in got}, len(got)


def test_report_equals_a_plain_version(spark):
    rows = made(random.Random(1), [None, *range(80)], 9)
    df = spark.createDataFrame(rows, KIND).repartition(5)
    for name, value in {"id": 1, "conv": 2, "at": 3, "line": 4, "first": 5, "copies": 6}.items():
        df = df.selectExpr("*", f"{value} as `{name}`")
    expected, (got, n) = plain(rows), report(df)
    assert n == len(expected) and got == {k: v[0] for k, v in expected.items()}


def test_conversations_over_many_partitions(spark):
    """One conversation with most rows is dealt over the tasks."""
    rnd = random.Random(2)
    rows = made(rnd, range(4), 12) + [(77, i, "user" if rnd.random() < 0.3 else ENDS[i % 2],
                                       rnd.choice(["Same.", f"Own {i}.", "No end", ""])) for i in range(3000)]
    expected, (got, _) = plain(rows), report(spark.createDataFrame(rows, KIND))
    assert got == {k: v[0] for k, v in expected.items()}


def test_repaired_turns(spark):
    rows = made(random.Random(4), range(30), 8)
    df = spark.createDataFrame(rows, KIND)
    lines = {}
    for r in turn_repair.repaired_turns(turn_repair.damaged(df)).orderBy("conv_id", "place").collect():
        assert r["place"] == len(lines.setdefault(r["conv_id"], []))
        lines[r["conv_id"]].append(r["line"])
    assert lines == {k: v[1] for k, v in plain(rows).items() if v[1]}


def test_many_copies_very_long_and_empty(spark):
    long = "word " * 200_000 + "."
    rows = [(1, 2, "user", "Again.")] * 500 + [(1, 3, "assistant", "Done."), (2, 1, "user", long), (2, 2, "assistant", long)]
    expected, (got, _) = plain(rows), report(spark.createDataFrame(rows, KIND))
    assert got == {k: v[0] for k, v in expected.items()}
    assert report(spark.createDataFrame([], KIND)) == ({}, 0)


def test_a_conversation_without_rows_left(spark):
    conv, turn = next((c, t) for c in range(100) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got, _ = report(spark.createDataFrame([(conv, turn, "user", "x")], KIND))
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_letters_of_rows():
    assert list(row_letters("IKDDKI", [1, 2, 1])) == ["IK", "DD", "KI"]
    assert edited("IR", 0, 2, "tool:x", 4) == ["user:", "assistant:x"]
