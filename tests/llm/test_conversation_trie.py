"""Prefix tries of conversations against a brute-force trie."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from llm_helpers import clashing

from tickloom.llm import conversation_trie as ct
from tickloom.llm.prefix_forest import Sequence, common, forest, merge

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_rebuilt(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, v in convs.items():
        v.sort()
    for c, v in convs.items():
        led = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(t[1:] for t in convs.get(c - c % 20, [])[:led] + v[led:])
    return out


def brute(rows):
    sequences = brute_rebuilt(rows)
    nodes = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[x] for x in below) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = sum(saved[x] for x in below) + (len(nodes[path]) - 1) * words
    rows = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if sequences[c] == path)
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        shape = (len(members), len(children.get(path, [])), leaves[path], saved[path])
        rows.append((min(members), len(path), parent, *shape, digest))
    return sorted(rows, key=str)


def invented(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            text = rng.choice(["hi", "a b c", "", " \t", None, "x y", f"u{rng.randrange(3)}"])
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), text))
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("segment, turns, fan_in", [(1_024, 100_000, 64), (1_024, 10, 3), (2, 15, 2)])
def test_equals_brute_force(spark, monkeypatch, segment, turns, fan_in):
    monkeypatch.setattr(ct, "RANGE_TURNS", turns)
    monkeypatch.setattr(ct, "FAN_IN", fan_in)
    rows = invented(segment + turns)
    rows += [r for r in rows if r[0] == 20]  # repeated rows
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    assert found(ct.prefix_trie(*ct.rebuilt(df), segment=segment)) == brute(rows)


def test_long_conversation_and_a_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(ct, "RANGE_TURNS", 200)
    rows = [(3, t, "user", f"t{t % 7}") for t in range(400)] + [(4, t, "user", f"t{t % 7}") for t in range(398)]
    rows += [(c, t, "user", f"same {t}") for c in range(40, 240) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(ct.prefix_trie(*ct.rebuilt(df), segment=64)) == brute(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ct.conversation_trie(empty).collect() == []
    nulls = spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)
    assert ct.conversation_trie(nulls).collect() == []
    # its only turn is one of those it would take over, and no leader gives any
    assert zlib.crc32(b"5") % 4 >= 1
    rows = [(5, 0, "user", "a"), (None, 0, "user", "b"), (-5, 0, None, None), (-5, None, "user", "x" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    convs = {c: s for c, s in brute_rebuilt([r for r in rows if r[0] != -5]).items()}
    assert convs == {5: ()}
    got = found(ct.conversation_trie(df))
    assert {(r[0], r[1]) for r in got if r[1] == 0} == {(-5, 0)}
    assert all(r[2] is None for r in got if r[1] == 0)


def test_ranges_and_their_merge_equal_one_range():
    rng = random.Random(9)
    for _ in range(60):
        keys = set()
        for g in range(2):
            for _ in range(rng.randrange(1, 20)):
                keys.add((bytes([g]) * 16, b"".join(bytes([rng.randrange(2)]) * 16 for _ in range(rng.randrange(6)))))
        items = [
            Sequence(g, k, [sum(k[: 16 * d]) % 5 for d in range(1, len(k) // 16 + 1)], rng.randrange(1, 4), i, str(i), None, 0, 0, 0)
            for i, (g, k) in enumerate(sorted(keys))
        ]
        cuts = [0, *sorted(rng.sample(range(1, len(items)), min(5, len(items) - 1))), len(items)]
        ranges = [items[a:b] for a, b in zip(cuts, cuts[1:])]
        done, blocks = [], []
        for i, part in enumerate(ranges):
            left = common(ranges[i - 1][-1], part[0]) if i else -1
            right = common(part[-1], ranges[i + 1][0]) if i + 1 < len(ranges) else -1
            nodes = forest(part, left, right)
            done += [x for x in nodes if not x.left | x.right]
            blocks.append([x for x in nodes if x.left | x.right])
        while len(blocks) > 1:
            pairs = [blocks[i : i + 2] for i in range(0, len(blocks), 2)]
            merged = [merge([(x, i == 0, i == len(p) - 1) for i, b in enumerate(p) for x in b]) for p in pairs]
            done += [x for m in merged for x in m if not x.left | x.right]
            blocks = [[x for x in m if x.left | x.right] for m in merged]
        assert not blocks[0]
        late = {x.id: x.conv for x in done if x.id}

        def plain(nodes, late):
            return sorted(
                (x.group, x.depth, x.conv, str(late[x.parent_id] if x.parent_id else x.parent), *x[6:12]) for x in nodes
            )

        assert plain(done, late) == plain(forest(items, -1, -1), {})


def test_places_go_on_across_ranges(spark):
    rows = [(k, i) for k, n in ((1, 3), (2, 500), (3, 1), (4, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, i long").selectExpr("k", "i", "i AS same").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        out = ct.numbered(df, "k", ["i"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(out) == len(rows)
    assert all(r["pos"] == r["same"] for r in out)
