from __future__ import annotations

import re

import numpy as np
import pytest
from llm_helpers import make_docs, prose, smallest_reachable  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm import parity_join
from tickloom.llm.parity_join import Similarity, drop_similar, jaccard_classes


WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if 0 < len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def expected(rows, rule):
    sets = {i: shingles(t, rule.words) for i, t in rows}
    ids = sorted(sets)
    linked = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and rule.parts * both >= rule.needed * (len(sets[a]) + len(sets[b]) - both):
                linked.append((a, b))
    tops = smallest_reachable(ids, linked)
    return {i: (len(sets[i]), tops[i]) for i in ids}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def family(prose, seed, words, copies, edits):
    """Texts that drift: each copy changes some more words of the one before."""
    text = prose(words, seed).split()
    rng = np.random.default_rng(seed)
    out = [" ".join(text)]
    for _ in range(copies):
        for at in rng.integers(0, len(text), edits):
            text[at] = f"edit{rng.integers(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def rows(prose):
    texts = ["", None, " \t\n", "one", "One", "one two", "ONE  two\n", "one two three", "é É", "é é"]
    texts += ["a b c d e f g h i j k l"] * 3 + ["spam " * 400, "spam " * 500]
    for seed, (words, edits) in enumerate([(12, 1), (40, 1), (120, 1), (300, 3), (300, 9), (900, 10)]):
        texts += family(prose, seed, words, 12, edits)
    texts += [prose(30, 90 + i, 12) for i in range(25)]  # shared words, few shared shingles
    return [(1_000 - i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rule", [Similarity(), Similarity(5, 80, 100)])
def test_components_match_all_pairs(make_docs, rows, rule):
    assert got(jaccard_classes(make_docs(rows), rule)) == expected(rows, rule)


def test_split_groups_lose_no_link(make_docs, rows, monkeypatch):
    monkeypatch.setattr(parity_join, "BLOCK", 3)
    monkeypatch.setattr(parity_join, "SMALL", 3)
    monkeypatch.setattr(parity_join, "HUB", 2)
    monkeypatch.setattr(parity_join, "FIRST", 3)
    assert got(jaccard_classes(make_docs(rows))) == expected(rows, Similarity())


def test_rows_beyond_the_named_ones_are_verified(spark, make_docs, monkeypatch):
    """Document 1 links with eight at distance 8 and with document 10 at distance 10.

    The sketch of document 0 collides with that of document 1, so all its pairs are refuted.
    """
    words = [f"v{i}" for i in range(102)]
    spans = [(at, 2) for at in range(5, 85, 10)] + [(92, 3)]
    edited = [words[:at] + [f"e{at}-{i}" for i in range(n)] + words[at + n :] for at, n in spans]
    rows = list(enumerate(" ".join(w) for w in [[f"x{i}" for i in range(102)], words, *edited]))
    rule, real = Similarity(), parity_join.sketches

    def collided(docs, rule):
        found = real(docs, rule)
        other = found.filter("doc_id = 1").select("band", F.col("words").alias("w"))
        words = F.when(F.col("doc_id") == 0, F.col("w")).otherwise(F.col("words"))
        return found.join(other, "band").select("doc_id", "n", "band", words.alias("words"))

    def one_group(docs, rule, parts, again):
        band = int(np.searchsorted(rule.bands(), 100, side="right")) - 1
        members = bytearray(np.arange(len(rows)).tobytes())
        return docs.sparkSession.createDataFrame([(band, members)], "band int, members binary")

    monkeypatch.setattr(parity_join, "sketches", collided)
    monkeypatch.setattr(parity_join, "candidate_groups", one_group)
    want = expected(rows, rule)
    assert [top for _, top in want.values()] == [0] + [1] * 10
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # rows of the group in order
    try:
        assert got(jaccard_classes(make_docs(rows), rule)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_blocks_cover_what_they_have_to():
    rng = np.random.default_rng(6)
    for n in (2, 30, 2 * parity_join.BLOCK + 700):
        members = rng.permutation(10 * n)[:n].astype(np.int64)
        tops = members[rng.integers(0, max(n // 40, 2), n)]
        blocks = list(parity_join._blocks(members, tops))
        assert max(map(len, blocks), default=0) <= 2 * parity_join.BLOCK
        top = dict(zip(members.tolist(), tops.tolist()))
        sets = [set(b.tolist()) for b in blocks]
        for _ in range(500):
            a, b = (int(x) for x in rng.choice(members, 2))
            if top[a] != top[b]:
                assert any(a in s and b in s for s in sets)
        assert not list(parity_join._blocks(members, np.zeros(n, np.int64)))


@pytest.mark.parametrize("rule", [Similarity(), Similarity(5, 80, 100)])
def test_rows_of_a_document_do_not_grow_with_its_group(make_docs, prose, monkeypatch, rule):
    monkeypatch.setattr(parity_join, "BLOCK", 100)
    monkeypatch.setattr(parity_join, "SMALL", 20)
    monkeypatch.setattr(parity_join, "HUB", 10)
    real, sent = parity_join.candidate_groups, []

    def counted(*args):
        groups = real(*args).cache()
        groups_only = groups.filter("band >= 0")
        sent.append(groups_only.select(F.sum(F.length("members") / 8)).first()[0] or 0)
        return groups

    monkeypatch.setattr(parity_join, "candidate_groups", counted)
    base, rng, each = prose(200, 5).split(), np.random.default_rng(5), []
    for n in (200, 1_600):
        texts = []
        for i in range(n):
            text = list(base)
            for at in rng.integers(0, len(text), 2):
                text[at] = f"edit{rng.integers(10**6)}"
            texts.append(" ".join(text))
        sent.clear()
        found = got(jaccard_classes(make_docs(texts), rule))
        assert {top for _, top in found.values()} == {0}
        each.append(sum(sent) / n)
    assert each[1] < 1.3 * each[0] < 1.3 * 3 * parity_join.FIRST


@pytest.mark.parametrize("rule", [Similarity(), Similarity(5, 80, 100)])
def test_rows_of_a_group_with_outsiders_do_not_grow(make_docs, prose, monkeypatch, rule):
    """Every third text is a little too far from most others, so large groups stay apart."""
    monkeypatch.setattr(parity_join, "BLOCK", 100)
    monkeypatch.setattr(parity_join, "SMALL", 20)
    monkeypatch.setattr(parity_join, "HUB", 10)
    real, sent = parity_join.pairs_to_verify, []

    def counted(groups, *args):
        large = groups.filter(F.length("members") > 8 * parity_join.SMALL)
        sent.append(large.select(F.sum(F.length("members") / 8)).first()[0] or 0)
        return real(groups, *args)

    monkeypatch.setattr(parity_join, "pairs_to_verify", counted)
    base, rng, texts = prose(200, 7).split(), np.random.default_rng(7), []
    far = 200 * (rule.parts - rule.needed) // (2 * rule.parts * rule.words)
    for i in range(300):
        text = list(base)
        for at in rng.integers(0, len(text), 1 + (2 * far if i % 3 == 2 else 0)):
            text[at] = f"edit{rng.integers(10**6)}"
        texts.append(" ".join(text))
    want = expected(list(enumerate(texts)), rule)
    tops = [top for _, top in want.values()]
    assert 20 < len(set(tops)) and tops.count(0) > 150
    assert got(jaccard_classes(make_docs(list(enumerate(texts))), rule)) == want
    assert sum(sent) < 3 * parity_join.FIRST * len(texts)


def test_rest_of_a_component_meets_all_of_it(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "BLOCK", 3)
    held, rest = list(range(10)), [[20, 21, 22, 23], [23, 24]]
    tops = spark.createDataFrame([(i, 0) for i in held] + [(i, i) for i in range(20, 25)], "doc_id long, top long")
    found = [(4, 0, bytearray(np.array(r, np.int64).tobytes())) for r in rest]
    found.append((5, None, bytearray(np.array([30, 31], np.int64).tobytes())))
    groups = parity_join._met(spark.createDataFrame(found, parity_join.GROUPS), tops).collect()
    sets = [(g["band"], set(np.frombuffer(g["members"], np.int64).tolist())) for g in groups]
    assert (5, {30, 31}) in sets
    for a in range(20, 25):
        for b in [*held, *range(20, 25)]:
            assert any(band == 4 and {a, b} <= s for band, s in sets)


def test_rows_of_one_id_with_different_texts(make_docs):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, "zz " + long), (2, long + " end"), (3, "other words here")]
    for order in (rows, rows[::-1]):
        out = {(r["doc_id"], r["component_id"]) for r in jaccard_classes(make_docs(order)).collect()}
        assert out == {(1, 1), (2, 1), (3, 3)}


def test_bands_of_linked_sets_are_neighbours():
    for rule in (Similarity(), Similarity(5, 80, 100)):
        first = rule.bands()
        classes, equal = rule.classes(first)
        for a in range(1, 2_000):
            for b in {a, a * rule.parts // rule.needed}:
                low, high = np.searchsorted(first, [a, b], side="right") - 1
                assert high - low <= 1
                assert classes[low] - equal[low] >= rule.difference(a + b)


def test_hamming_distance_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        one = rng.integers(0, 2**63, 300, dtype=np.uint64)
        two = np.concatenate([one[20:], rng.integers(0, 2**63, 9, dtype=np.uint64)])
        words = [parity_join._flips(x, np.array([len(x)]), np.array([4])) for x in (one, two)]
        assert np.bitwise_count(words[0] ^ words[1]).sum() <= 29
        classes = [parity_join._classes(x, np.array([len(x)]), np.array([40])) for x in (one, two)]
        assert (classes[0] != classes[1]).sum() <= 29


def test_keys_survive_packing():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**40, 90_000, dtype=np.uint64)
    for documents in (5, 80_000):
        docs = rng.integers(-(2**62), 2**62, documents)[rng.integers(0, documents, len(keys))]
        got = parity_join._unpacked(*parity_join._packed(keys, docs, docs ^ 5))
        assert np.array_equal(got[0], keys) and np.array_equal(got[1], docs)
        assert np.array_equal(got[2], docs ^ 5)


def test_one_of_each_component_stays(make_docs, rows):
    docs = make_docs(rows + [(None, "one two")])
    left = drop_similar(docs)
    assert left.columns == docs.columns
    want = {i for i, (_, top) in expected(rows, Similarity()).items() if i == top}
    assert {r["doc_id"] for r in left.collect()} == want | {None}


def test_repeated_rows_and_null_ids(make_docs):
    docs = make_docs([(1, "a b c d"), (1, "a b c d"), (2, "A b c d"), (None, "a b c d")])
    out = sorted((r["doc_id"] or 0, r["component_id"]) for r in jaccard_classes(docs).collect())
    assert out == [(0, None), (1, 1), (1, 1), (2, 1)]


def test_empty_table(make_docs):
    assert jaccard_classes(make_docs([])).collect() == []
