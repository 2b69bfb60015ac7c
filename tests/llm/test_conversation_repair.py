"""Conversation repair against brute force over all sequences of edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from conftest import SF01

from epilake.llm import conversation_repair as cr
from epilake.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, conv string, seen long, look string"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def said(v):
    return " " if v is None else str(v)


def brute_damage(rows):
    """Rows of one conversation (conv_id, turn, role, text) after damage, in order."""
    out = []
    for c, turn, role, text in rows:
        role, text = said(role), said(text)
        kind = zlib.crc32(f"{said(c)}:{said(turn)}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def brute_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_edits(rows, faults):
    """Cheapest, then ASCII-least sequence of edits, by uniform cost search
    over (cost, audit); the pattern is tested on the whole result."""
    heap = [(0, "", 0, ())]
    done = set()
    while heap:
        cost, audit, i, made = heapq.heappop(heap)
        roles = "".join(r[:1] or "-" for r, _ in made)
        if not re.fullmatch("(s?(ua)*u?)?", roles):
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in made)
        key = (i, roles[-1:])
        if key in done:
            continue
        done.add(key)
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", i, (*made, (role, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, made))
            if faults[i] not in ("b", "d"):
                late = 5 * (faults[i] == "t")
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, (*made, (role, text))))
                for to in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 1 + late, audit + "R", i + 1, (*made, (to, text))))


def brute(rows, damage=True):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for c, rs in groups.items():
        now = brute_damage(rs) if damage else sorted(
            ((t, said(r), said(x)) for _, t, r, x in rs), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = brute_faults(now)
        turns = {t for t, _, _ in now if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(now, now[1:]))
        cost, audit, text = brute_edits(now, faults)
        out[c] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
                  hashlib.sha256(text.encode()).hexdigest())
    return out


def result(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                     "repaired_sha256").collect()
    got = {r[0]: tuple(r[1:]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.op13_conversation_repair(spark, SF01)) == brute(rows)


def odd_rows():
    rng = random.Random(5)
    texts = ["Hello.", "What?", "no end", "", "  \n\t ", "so. \x0b", None, "Done!", "日本語。", " ", "é.", "x.\n" * 3]
    roles = ["user", "assistant", "system", "tool", "", None, "usher"]
    rows = []
    for c in [None, *range(-3, 150)]:
        for t in range(rng.randint(1, 7)):
            turn = rng.choice([t, t, t, t + 2, None, -1])
            rows.append((c, turn, rng.choice(roles[:3] if rng.random() < 0.7 else roles), rng.choice(texts)))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    rows.append((500, -2**63, "user", "least.")), rows.append((500, 2**63 - 1, "user", "most."))
    return rows


@pytest.mark.parametrize("damage", [True, False])
def test_odd_rows(spark, damage):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(7)
    made = cr.damaged(df) if damage else cr.plain_rows(df)
    want = brute(rows, damage)
    if 500 in want:
        want[500] = (min(want[500][0], 2**63 - 1), *want[500][1:])
    assert result(cr.repair(made)) == want


def test_a_conversation_with_every_row_dropped_and_an_empty_table(spark):
    dropped = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    df = spark.createDataFrame([(c, 0, "user", "Hi.", "", 0, "") for c in dropped], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert result(cr.repair(cr.damaged(df))) == {c: (0, 0, 0, 0, 0, 0, "", empty) for c in dropped}
    assert cr.repair(cr.damaged(df.limit(0))).collect() == []


def test_giant_conversation_spills_and_crosses_batches(spark):
    n, long = 30_000, "word " * 200_000 + "."
    rows = [(7, t, ["user", "assistant"][t % 2], long if t % 9_000 == 11 else f"{t % 9_000}. {'x' * 300}.") for t in range(n)]
    assert sum(len(r[3]) for r in rows) > 2 * cr.SPOOL
    df = spark.createDataFrame([(*r, "", 0, "") for r in rows], SCHEMA)
    got = result(cr.repair(cr.plain_rows(df)))[7]
    assert got[2] == n - 9_000 and got[5] == 2 * got[2] and got[4] == 0
    assert got[6] == "K" * 9_000 + "D" * (n - 9_000)
    kept = rows[:9_000]
    assert got[7] == hashlib.sha256("\n".join(f"{r[2]}:{r[3]}" for r in kept).encode()).hexdigest()
