"""Conversation repair against exhaustive search."""

import heapq
import random
import re
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import conversations as cv


def searched(rows):
    """Cheapest edits of (initial, fault), by best-first search over (cost, audit)."""
    seen, heap = set(), [(0, "", 0, "")]
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if (i, out) in seen:
            continue
        seen.add((i, out))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            return cost, audit
        if len(out) > len(rows) + 3:
            continue
        for c in "ua":
            heapq.heappush(heap, (cost + 3, audit + "I", i, out + c))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, out))
            if fault != cv.GONE:
                more = 3 * (fault == cv.TRUNCATED)
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, out + initial))
                for c in "ua":
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, out + c))
    raise AssertionError


def decided(rows):
    paths = cv.cheapest([r[0] for r in rows], [r[1] for r in rows], cv.NOTHING)
    return min(paths[q] for q in cv.ENDS if paths[q] is not None)


def test_integer_minimum_is_the_search():
    rng = random.Random(2)
    for _ in range(250):
        rows = [(rng.choice("suuaatx"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(6))]
        assert decided(rows) == searched(rows), rows


def batch(rows, names):
    return iter([pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)])


def test_blocks_join_to_the_whole():
    rng = random.Random(3)
    for _ in range(40):
        rows = [(rng.choice("suuaaax"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(1, 60))]
        size = rng.choice([1, 2, 7])
        cut = [("=1", i // size, i, *r) for i, r in enumerate(rows)]
        paths = [r for b in cv.paths_of_blocks(batch(cut, ["conv", "block", "rn", "initial", "fault"])) for r in zip(*(c.to_pylist() for c in b.columns))]
        chosen = [r for b in cv.joined_blocks(batch(paths, cv.PATHS.names)) for r in zip(*(c.to_pylist() for c in b.columns))]
        by = {p[:4]: p[4:] for p in paths}
        taken = [by[c[:4]] for c in sorted(chosen, key=lambda c: c[1])]
        assert (sum(t[0] for t in taken), "".join(t[1] for t in taken)) == decided(rows)


def judged(rows):
    """Initial and fault of (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def repaired(rows, audit):
    total, out, i = sum(a != "D" for a in audit), [], 0
    for a in audit:
        role = "user" if (len(out) - total % 2) % 2 == 0 else "assistant"
        if a == "I":
            out.append((role, ""))
            continue
        if a != "D":
            out.append((rows[i][0] if a == "K" else role, rows[i][1]))
        i += 1
    return out


def check(got, given):
    """``given``: conversation -> rows (turn, role, text)."""
    told = {r["conv_id"]: r.asDict() for r in got.conversations.collect()}
    lines = {}
    for r in got.rows.collect():
        lines.setdefault(r["conv_id"], []).append((r["pos"], r["role"], r["text"]))
    assert set(told) == set(given)
    for conv, rows in given.items():
        filled = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows))
        rows_ = [r[2:] for r in filled]
        faults = judged(rows_)
        code = {"blank": cv.GONE, "duplicate": cv.GONE, "truncated": cv.TRUNCATED, None: cv.FINE}
        cost, audit = decided([(i, code[f]) for i, f in faults])
        turns = [r[1] for r in filled if r[0]]
        want = {"conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "cost": cost, "audit": audit,
                **{f: sum(x[1] == f for x in faults) for f in ("blank", "duplicate", "truncated")},
                "illegal": sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))}
        assert told[conv] == want
        assert [x[1:] for x in sorted(lines.get(conv, []))] == repaired(rows_, audit)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_odd_conversations(spark):
    given = {
        1: [(0, "system", "Be kind."), (1, "user", "Hi!"), (2, "assistant", "Hello.")],
        2: [(0, "assistant", "A."), (0, "assistant", "A."), (None, "user", None), (None, None, "no role."), (7, "", "?")],
        None: [(5, "user", "x"), (5, "user", "x"), (6, "system", " \t\n"), (9, "tool", "y!"), (2**62, "user", "z."), (-(2**62), "user", "w.")],
        3: [(None, None, None)],
        4: [(1, "user", "long " * 200_000 + ".\n\n"), (2, "assistant", "Ünd?")],
        5: [(i, "user", "same.") for i in range(30)],
    }
    rows = [(c, *r) for c, rs in given.items() for r in rs]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("conv", "rn", "block", "said", "fault", "initial", "pos", "audit", "way", "copy")})
    check(cv.repair(frame), given)
    assert cv.repair(frame.limit(0)).conversations.count() == 0 and cv.repair(frame.limit(0)).rows.count() == 0


def test_a_conversation_of_several_blocks(spark):
    rng = random.Random(8)
    n = 2 * cv.BLOCK_ROWS + 300
    given = {
        7: [(i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["fine.", f"row {i}.", f"cut {i}", "", " "])) for i in range(n)],
        8: [(i, ["user", "assistant"][i % 2], f"row {i}.") for i in range(cv.BLOCK_ROWS)],
    }
    rows = [(c, *r) for c, rs in given.items() for r in rs]
    rng.shuffle(rows)
    check(cv.repair(spark.createDataFrame(rows, SCHEMA)), given)


def test_damage(spark):
    rows = [(c, t, r, x) for c in (1, 22, None) for t in (*range(60), None) for r, x in (("assistant", "Yes. No! Why?"), (None, None))]
    got = sorted(tuple(r) for r in cv.damage(spark.createDataFrame(rows, SCHEMA)).select("role", "text").collect())
    want = []
    for c, t, r, x in rows:
        way = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if way == 1 else re.sub("[.!?]", "", x) if way == 2 else x
        want += [("user" if way == 4 else r, x)] * (0 if way == 0 else 2 if way == 3 else 1)
    assert got == sorted(want)
