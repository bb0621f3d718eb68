"""Repair of conversations against a search over all edits."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from llm_helpers import clashing

from tickloom.llm.conversation_repair import damaged, repair_conversations
from tickloom.llm.repair_dawg import Automaton

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\f\r"
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def brute_repair(rows):
    """Cost, audit and repaired rows of (role, text, must_go, truncated)."""

    @lru_cache(None)
    def best(i, state, inserts):
        out = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def step(paid, edit, row, rest):
            if rest:
                out.append((paid + rest[0], edit + rest[1], (row, *rest[2]) if row else rest[2]))

        for role in ("user", "assistant"):
            if inserts < 4 and (state, role[0]) in AFTER:
                step(3, "I", (role, ""), best(i, AFTER[state, role[0]], inserts + 1))
        if i < len(rows):
            role, text, must_go, truncated = rows[i]
            step(4, "D", None, best(i + 1, state, 0))
            if not must_go:
                if (state, role[:1]) in AFTER:
                    step(3 * truncated, "K", (role, text), best(i + 1, AFTER[state, role[:1]], 0))
                for other in ("user", "assistant"):
                    if (state, other[0]) in AFTER:
                        step(3 + 3 * truncated, "R", (other, text), best(i + 1, AFTER[state, other[0]], 0))
        return min(out) if out else None

    return best(0, 0, 0)


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, [])
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        damage = zlib.crc32(name.encode()) % 20
        r, x = (" " if v is None else v for v in (r, x))
        if damage == 0:
            continue
        x = "" if damage == 1 else "".join(ch for ch in x if ch not in ".!?") if damage == 2 else x
        r = "user" if damage == 4 else r
        convs[c] += [((t is not None, t or 0), r, x)] * (2 if damage == 3 else 1)
    out = []
    for c, v in convs.items():
        v.sort()
        turns = [t[1] for t, _, _ in v if t[0]]
        seen, marked, counts = set(), [], {"b": 0, "d": 0, "t": 0}
        for _, r, x in v:
            trimmed = x.strip(SPACES)
            fault = "b" if not trimmed else "d" if (r, x) in seen else "" if trimmed[-1] in ".!?" else "t"
            seen.add((r, x))
            if fault:
                counts[fault] += 1
            marked.append((r, x, fault in ("b", "d") and fault != "", fault == "t"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(v, v[1:]))
        cost, audit, repaired = brute_repair(tuple(marked))
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in repaired).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, *counts.values(), illegal, cost, audit, digest))
    return sorted(out, key=str)


def invented(seed, convs=80):
    rng = random.Random(seed)
    texts = ["One.", "Two!", "cut", "", " \n", None, "Why? ", "é.", "a.b"]
    roles = ["user", "assistant", "system", "tool", None, "", "use"]
    rows = []
    for c in range(convs):
        rows += [
            (c if c else None, rng.choice([t, t, t, None]), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rng.choice(texts))
            for t in range(rng.randrange(1, 9))
        ]
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = invented(seed)
    rows += rows[:20]  # repeated rows
    df = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    assert found(repair_conversations(damaged(df))) == brute(rows)


def test_long_conversation(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Text {t}.") for t in range(100)]
    rows += [(2, 0, "user", "x" * 300_000 + "."), (2, 1, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(repair_conversations(damaged(df))) == brute(rows)


def test_conversation_that_is_gone_and_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(damaged(empty)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    assert found(repair_conversations(damaged(df))) == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ]


def test_automaton_equals_search_and_shares_suffixes():
    rng = random.Random(7)
    alphabet = "suaxSUAXd"
    signatures = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(7))) for _ in range(1500)}
    automaton = Automaton()
    for s in sorted(signatures, key=lambda s: s[::-1]):
        rows = tuple((c.lower(), "", c == "d", c.isupper()) for c in s)
        assert automaton.repair(s) == brute_repair(rows)[:2]
    suffixes = {s[i:] for s in signatures for i in range(len(s))}
    assert automaton.nodes == len(suffixes)  # each suffix once
    assert len(automaton.edges) < len(suffixes)


def test_edges_stay_few_however_long_the_signatures():
    automaton = Automaton()
    rng = random.Random(8)
    for n in (2_000, 20_000):
        signature = "".join(rng.choice("suaxSUAXd") for _ in range(n))
        cost, audit = automaton.repair(signature)
        assert len(audit) - audit.count("I") == n and cost > 0
    assert len(automaton.edges) < 1_000
