"""Repair of conversations against a search over all edits, and over the whole table against a plain cost table."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from tidemark.llm import repair as R
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows, faults):
    """(cost, audit, repaired) by uniform-cost search, ties by the audit: no bits, no layers."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, kept = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, kept
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in ("user", "assistant"):
            if (state, role[0]) in NEXT:
                heapq.heappush(queue, (cost + 5, audit + "I", i, NEXT[state, role[0]], (*kept, f"{role}:")))
        if i < len(rows):
            (_, role, text), fault = rows[i], faults[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, state, kept))
            if fault in (0, 3):
                more = 5 * (fault == 3)
                if (state, role[:1]) in NEXT:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, NEXT[state, role[:1]], (*kept, f"{role}:{text}")))
                for to in ("user", "assistant"):
                    if (state, to[0]) in NEXT:
                        heapq.heappush(queue, (cost + more + 1, audit + "R", i + 1, NEXT[state, to[0]], (*kept, f"{to}:{text}")))


def brute(rows):
    turns = defaultdict(list)
    for conv, *rest in damaged(rows):
        turns[conv].append(tuple(rest))
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(turns[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = faults_of(own)
        cost, audit, kept = cheapest(own, faults)
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def run(spark, rows, schema=SCHEMA):
    made = R.repair(R.damage(spark.createDataFrame(rows, schema).repartition(5))).collect()
    assert len(made) == len({r[0] for r in made})
    return {r[0]: tuple(r)[1:] for r in made}


def test_op13(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    made = QUERIES["op13_conversation_repair"](spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:] for r in made} == brute(rows) and len(made) == len({r[0] for r in rows})


@pytest.mark.parametrize("seed", range(3))
def test_random(spark, seed):
    rng = random.Random(seed)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "unknown", "User"], ["Hi.", "Yes!", "cut", "", " \t", None, "ok?", "née.\n", "x" * 3000, "a\x1c", "cut  "]
    rows = []
    for conv in range(150):
        for i in range(rng.randrange(0, 14)):
            text = rng.choice(texts[: rng.randrange(1, 12)])
            text = text if text is None or rng.random() < 0.3 else f"{text}{rng.randrange(99)}."
            rows.append((conv, rng.choice([i, i, i, i + 3, None]), rng.choice(roles[: rng.randrange(2, 9)]), text))
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (-3, None, "user", "a."), (-3, None, "assistant", "b.")] + rows[:40]
    assert run(spark, rows) == brute(rows)


def test_long_and_dropped(spark):
    """A conversation of thousands of turns; one whose rows all go; columns with clashing names; an empty table."""
    rng = random.Random(8)
    rows = [(1, i, rng.choice(["user", "assistant", "assistant", "system"]), f"{i} {rng.choice(['a.', 'b', ''])}") for i in range(5000)]
    gone = next(c for c in range(10, 10000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Hi."))
    made = run(spark, rows)
    assert made == brute(rows)
    assert made[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    wide = [(*r, 1, "f", True) for r in rows[:50]]
    assert run(spark, wide, SCHEMA + ", fault int, first string, dropped boolean") == brute(rows[:50])
    assert R.repair(R.damage(spark.createDataFrame([], SCHEMA))).count() == 0


def test_layers_reach():
    """A word holds all that differs: costs from every state, by a table, lie within its layers."""
    rng = random.Random(2)
    for _ in range(300):
        turns = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(0, 30))]
        word = R.last()
        for first, fault in reversed(turns):
            word = R.step(*word, first, fault)
        costs = [table(tuple(turns), s) for s in range(4)]
        assert [R.cost_of(*word, s) for s in range(4)] == costs and max(costs) - min(costs) <= R.REACH


@lru_cache(maxsize=None)
def table(turns, state, inserted=0):
    """The least cost from a state on, by recursion."""
    best = []
    if not turns and state in (R.START, R.ASSISTANT):
        best.append(0)
    if inserted < 3:
        best.append(R.INSERT + table(turns, R.ASSISTANT if state == R.USER else R.USER, inserted + 1))
    if turns:
        (first, fault), rest = turns[0], turns[1:]
        best.append(R.DELETE + table(rest, state))
        if fault in (0, 3):
            more, to = R.TRUNCATED * (fault == 3), R._moved(state, first)
            best.append(more + R.REROLE + table(rest, R.ASSISTANT if state == R.USER else R.USER))
            if to is not None:
                best.append(more + table(rest, to))
    return min(best, default=10**9)
