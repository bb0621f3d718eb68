from __future__ import annotations

import hashlib
import re

from llm_helpers import make_docs  # noqa: F401

from tickloom.llm.exact_dedup import drop_copies, exact_dedup

SPACES = re.compile("[\x20\x09-\x0d]")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACES.sub("", t or ""), []).append((i, t or ""))
    out = {}
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        for i, _ in members:
            out[i] = (best, len(members), i == best, hashlib.sha256(norm.encode()).hexdigest())
    return out


def decided(df):
    return {r["id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()}


ROWS = [
    (5, "a b c"),
    (3, "ab c"),
    (9, "a  b\tc\n"),
    (4, "abd"),
    (7, None),
    (8, ""),
    (10, " \r\n\x0b\x0c"),
    (11, "é" * 70_000),
    (12, "é " * 70_000),
    (13, "é" * 69_999 + "e"),
    (14, "a\xa0bc"),
    (15, "x" * 64 + "1"),
    (16, "x" * 64 + "2"),
    (None, "abd"),
]


def test_groups_match_brute_force(make_docs):
    assert decided(exact_dedup(make_docs(ROWS))) == expected(ROWS)


def test_ties_go_to_the_smallest_id(make_docs):
    rows = [(i, "same text") for i in (30, 20, 10)]
    assert decided(exact_dedup(make_docs(rows))) == expected(rows)


def test_repeated_rows_share_decisions_and_stay_once(make_docs):
    docs = make_docs([(1, "aa"), (1, "aa"), (2, "a a"), (3, "b"), (3, "b")])
    found = exact_dedup(docs).collect()
    assert len(found) == 5 and all(r["group_size"] == 3 for r in found if r["id"] in (1, 2))
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(2, "a a"), (3, "b")]


def test_rows_of_one_id_that_differ_in_spaces(make_docs):
    rows = [(1, "a b"), (1, "ab "), (1, " ab")]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        left = drop_copies(make_docs(order).repartition(3)).collect()
        assert [(r["doc_id"], r["text"]) for r in left] == [(1, "ab ")]


def test_one_row_of_each_group_stays(make_docs):
    stays = {i for i, d in expected(ROWS).items() if d[2]}
    assert {r["doc_id"] for r in drop_copies(make_docs(ROWS)).collect()} == stays


def test_empty_table(make_docs):
    assert exact_dedup(make_docs([])).collect() == []
    assert drop_copies(make_docs([])).collect() == []
