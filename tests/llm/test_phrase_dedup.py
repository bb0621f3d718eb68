from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pytest
from llm_helpers import make_docs, prose  # noqa: F401

from tickloom.llm import buckets
from tickloom.llm import grams
from tickloom.llm.phrase_dedup import Shard, remove_repeated_passages

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(rows, window):
    first, out = {}, {}
    for i, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        mine = [tuple(w[k : k + window]) for k in range(len(w) - window + 1)]
        for k, seen in enumerate(mine):
            if first.get(seen, i) < i:
                gone[k : k + window] = [True] * window
        for seen in mine:
            first.setdefault(seen, i)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def got(df):
    out = {}
    for r in df.collect():
        removed = sum(s["end"] - s["start"] for s in r["spans"])
        out[r["doc_id"]] = (r["n_words"], removed, r["kept"])
    return out


@pytest.fixture(scope="module")
def rows(prose):
    passage, other = prose(60, 1), prose(55, 2)
    texts = [None, "", " \n", "short text", prose(49, 3), passage, prose(300, 4)]
    texts += [f"{prose(20 + i, 10 + i)} {passage} {prose(30, 40 + i)}" for i in range(6)]
    texts += [f"{other}\t\n{prose(5, 70)}  {other} {passage} {other}", other.upper(), other]
    texts += ["same " * 500, "same " * 51, "same " * 50, "same " * 49, "é\xa0ü " * 80, "é\xa0ü " * 60]
    texts += [texts[8], texts[8], prose(6_000, 5), prose(6_000, 5) + " more"]
    cut = passage.split()
    texts += [" ".join(cut[:49] + ["x"] + cut[49:]), " ".join(cut[5:55]), " ".join(cut[5:54])]
    return [(900 - 3 * i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("phrase", [12, 50, 1])
def test_removed_words_match_brute_force(make_docs, rows, phrase):
    out = remove_repeated_passages(make_docs(rows), phrase=phrase)
    assert got(out) == expected(rows, 50)


def test_many_buckets(make_docs, rows, monkeypatch):
    monkeypatch.setattr(buckets, "BUCKET_BYTES", 3_000)
    assert got(remove_repeated_passages(make_docs(rows))) == expected(rows, 50)


def test_repeated_rows_and_null_ids(make_docs, prose):
    text = prose(80, 9)
    docs = make_docs([(4, text), (4, text), (None, text)])
    out = [(r["doc_id"], r["kept"]) for r in remove_repeated_passages(docs).collect()]
    assert sorted(out, key=str) == [(4, text), (4, text), (None, "")]


def test_empty_table(make_docs):
    assert remove_repeated_passages(make_docs([])).collect() == []


def words_and_hashes(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return text.encode().split(), grams.Words(raw, np.array([0, len(raw)])).hash


def test_a_shard_compares_around_every_phrase(prose):
    passage, text = prose(120, 1).split(), prose(30, 2).split()
    shard = Shard([5, 9], [" ".join(passage).encode(), b"other " * 50], 50, 12)
    for a, b in [(0, 120), (0, 50), (1, 51), (38, 88), (39, 89), (70, 120), (13, 99), (0, 49), (60, 109)]:
        doc = text + passage[a:b] + text
        marked = [30 <= i < 30 + b - a and b - a >= 50 for i in range(len(doc))]
        words, hashes = words_and_hashes(" ".join(doc))
        assert shard.repeated(6, words, hashes).tolist() == marked
        assert not shard.repeated(5, words, hashes).any()


def test_nothing_is_found_without_its_phrase(prose):
    passage = prose(60, 1).split()
    words, hashes = words_and_hashes(" ".join(passage))
    shard = Shard([1], [" ".join(passage).encode()], 50, 12)
    assert shard.repeated(2, words, hashes).all()
    late = words_and_hashes(" ".join(passage[1:]))  # only the second phrase is whole in it
    assert shard.repeated(2, *late).all()
    phrases = sorted(shard.automaton.items(), key=lambda item: item[1])
    assert len(phrases) == 2
    shard.automaton = ahocorasick.Automaton()
    shard.automaton.add_word(*phrases[0])
    shard.automaton.make_automaton()
    assert not shard.repeated(2, *late).any()


def test_periodic_texts(make_docs, prose):
    period = prose(70, 3)
    rows = [(1, "x " * 3_000), (2, "x " * 20_000), (3, f"{period} " * 9), (4, f"{prose(5, 4)} {period} " * 4)]
    rows += [(5, f"{period} " * 30), (6, "y z " * 400), (7, "z y " * 26)]
    assert got(remove_repeated_passages(make_docs(rows))) == expected(rows, 50)
