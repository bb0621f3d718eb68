from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from llm_helpers import make_docs  # noqa: F401

from tickloom.llm import lstm_crf, pii
from tickloom.llm.planted import planted
from tickloom.llm.queries import op4_personal_data

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            fine = [
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                14 <= len(digits) <= 19 and luhn(digits),
                10 <= len(digits) <= 15,
            ][kind]
            if fine:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


TEXTS = [
    "",
    "a@b.co, x.y+z%q@sub.example.org. @no.start a@b a@@b.c a@b.c@d.e a@b..c u@v.-.w",
    "1.2.3.4 256.1.1.1 01.002.0003.4 1.2.3.4.5.6.7.8 1.2.3 999.9.9.9.9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111, 0000 0000 0000 00",
    "+1 (555) 123-4567 +12 +1..2 ++49 30 1234567 +1234567890123456 +1 555 123 456 7 ",
    "é" * 50 + "me@ü.de me@x.de 😀 1.1.1.1",
    "٣.٣.٣.٣ +٣٣٣٣٣٣٣٣٣٣٣ 4111111111111111\n1",
    "7" * 30_000 + "@x." + "8" * 300,
    "x" * 30_000 + "@y.z" + " 1." * 500,
]


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(2)
    stock = list("0123456789..  --@@++()ab%_é") + ["1.2.3.4", "a@b.c", "+1 ", "4111111111111111"]
    texts = TEXTS + ["".join(rng.choice(stock, rng.integers(1, 80))) for _ in range(4_000)]
    for text in texts:
        if len(text) < 20_000:
            assert pii.base_spans(text) == brute(text), repr(text)
    assert [s[1] for s in pii.base_spans(TEXTS[-2])] == [0]


def test_gradients_match_differences():
    shape = lstm_crf.Shape(window=5, embedding=3, hidden=3, tags=3)
    rng = np.random.default_rng(1)
    chars, tags = rng.integers(60, 66, (5, 4)), rng.integers(0, 3, (5, 4))
    mask = np.arange(5)[:, None] < np.array([5, 3, 1, 4])
    w = {k: v.astype(np.float64) * 2 for k, v in lstm_crf.random_weights(shape).items()}
    w["move"] = rng.standard_normal((3, 3))
    _, grad = lstm_crf.loss_and_gradients(w, shape, chars, mask, tags)
    for name, g in grad.items():
        flat, at = w[name].reshape(-1), int(np.abs(g).argmax())
        kept, losses = flat[at], []
        for step in (1e-3, -1e-3):
            flat[at] = kept + step
            losses.append(lstm_crf.loss_and_gradients(w, shape, chars, mask, tags)[0])
        flat[at] = kept
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(g.reshape(-1)[at], rel=0.03, abs=2e-3)


def test_decoding_finds_the_best_path():
    shape = lstm_crf.Shape(window=4, embedding=3, hidden=3, tags=3)
    w = lstm_crf.random_weights(shape)
    rng = np.random.default_rng(7)
    w["move"] = rng.standard_normal((3, 3)).astype(np.float32)
    chars, mask = rng.integers(60, 90, (6, 4)), np.ones((6, 4), bool)
    found = lstm_crf.decode(w, shape, chars, mask)
    states, _ = lstm_crf._states(w, shape, chars.T, mask.T, keep=False)
    scores = states @ w["emit"] + w["emit_bias"]
    for i in range(6):
        paths = np.stack(np.meshgrid(*[range(3)] * 4, indexing="ij"), -1).reshape(-1, 4)
        value = w["begin"][paths[:, 0]] + sum(scores[t, i, paths[:, t]] for t in range(4))
        value = value + sum(w["move"][paths[:, t], paths[:, t + 1]] for t in range(3))
        assert found[i].tolist() == paths[value.argmax()].tolist()


def test_windows_reach_every_digit_and_at_sign():
    shape = lstm_crf.Shape()
    rng = np.random.default_rng(4)
    for n in (1, 95, 96, 97, 500, 3_000):
        text = "".join(rng.choice(list("abc ") * 20 + ["1", "@", " dot ", "(AT)"], n))
        codes = pii._codes(text)
        starts = pii.windows(codes, shape, pii._spelled(text))
        seen = {int(s) + k for s in starts for k in range(shape.window)}
        assert {i for i, c in enumerate(text) if c in "1@"} <= seen
        assert {m.start() for m in re.finditer(r"[(]AT[)]", text)} <= seen


def test_windows_are_reconciled_by_the_nearest_middle():
    tags = np.array([[1] * 6, [2] * 6], dtype=np.int8)
    out = pii.reconciled(9, np.array([0, 3]), tags, np.ones((2, 6), bool))
    assert out.tolist() == [1, 1, 1, 1, 1, 2, 2, 2, 2]
    assert pii.tagged_spans(np.array([0, 1, 2, 2, 1, 0, 4, 4, 3], np.int8)) == [
        (1, 0, 4), (4, 0, 5), (6, 1, 8), (8, 1, 9),
    ]


def test_registered_query_keeps_the_base_spans(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_personal_data(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        named = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        counts = [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]]
        assert counts == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(named) <= set(r["spans"].split(","))


@pytest.fixture(scope="module")
def halves(spark):
    """Weights fitted to the even documents of sf0.1, and texts of the odd ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("length(text) < 20000")
    odd = docs.filter("doc_id % 2 = 1").orderBy("doc_id").select("text").toArrow()
    return pii.fit(docs.filter("doc_id % 2 = 0")), odd.column("text").to_pylist()


def test_the_network_finds_most_base_spans_it_has_not_seen(halves):
    weights, texts = halves
    shape, found, all_ = lstm_crf.Shape(), 0, 0
    for text in [t for t in texts if pii._TRIGGER.search(t)][:300]:
        base = pii.base_spans(text)
        codes = pii._codes(text)
        starts = pii.windows(codes, shape, pii._spelled(text))
        laid, mask = pii._laid(codes, starts, shape)
        tags = lstm_crf.decode(weights, shape, laid, mask)
        got = set(pii.tagged_spans(pii.reconciled(len(codes), starts, tags, mask)))
        found += len(got & set(base))
        all_ += len(base)
    assert found >= 0.85 * all_


def test_the_network_finds_what_the_patterns_miss(halves, make_docs):
    """Unseen forms in unseen texts, among lookalikes; and next to nothing in the texts alone."""
    weights, texts = halves
    pieces = planted(texts, 1_200, seed=99)
    rows = pii.find_spans(make_docs([t for t, _ in pieces]), weights).collect()
    right, wrong, missed = [0] * 4, [0] * 4, [0] * 4
    for r in rows:
        text, spans = pieces[r["doc_id"]]
        all_ = list(zip(r["start"], map(pii.KINDS.index, r["kind"]), r["end"], r["base"]))
        base = [s[:3] for s in all_ if s[3]]
        added = {s[:3] for s in all_ if not s[3]}
        gold = {s for s in spans if not any(a < s[2] and s[0] < b for a, _, b in base)}
        for found, counts in ((added & gold, right), (added - gold, wrong), (gold - added, missed)):
            for _, kind, _ in found:
                counts[kind] += 1
        for start, _, end in added:
            assert start == 0 or not (text[start - 1].isalnum() and text[start].isalnum())
            assert end == len(text) or not (text[end - 1].isalnum() and text[end].isalnum())
    for kind in range(4):
        assert right[kind] >= 0.9 * (right[kind] + wrong[kind]), (kind, right, wrong)
        assert right[kind] >= 0.9 * (right[kind] + missed[kind]), (kind, right, missed)
    alone = pii.find_spans(make_docs(texts[:1_000]), weights).collect()
    assert sum(not fixed for r in alone for fixed in r["base"]) <= 2


def test_checks_of_added_spans():
    assert pii.plausible(0, "ann at x dot com") and pii.plausible(0, "ann(at)x.org")
    assert not pii.plausible(0, "ann x dot com") and not pii.plausible(0, "at 12")
    assert pii.plausible(1, "1[.]2[.]3[.]255") and not pii.plausible(1, "1 dot 2 dot 3 dot 256")
    assert pii.plausible(2, "4111/1111/1111/1111") and not pii.plausible(2, "4111/1111/1111/1112")
    assert pii.plausible(3, "+49 3O l234 5678") and not pii.plausible(3, "call 030 1234 5678")
    assert pii._whole("ab 123456 x", 5, 7) == (3, 9)


def test_edge_cases(make_docs):
    docs = make_docs([(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "a@b.c"), (1, TEXTS[1])])
    for weights in (None, pii.fit(docs)):
        rows = pii.find_spans(docs, weights).collect()
        assert len(rows) == len(TEXTS) + 3
        for r in rows:
            text = TEXTS[r["doc_id"]] if r["doc_id"] is not None and r["doc_id"] < 50 else ""
            base = [(a, b) for a, b, fixed in zip(r["start"], r["end"], r["base"]) if fixed]
            if len(text) < 20_000 and r["doc_id"] is not None:
                assert base == [(a, b) for a, _, b in brute(text)]
    assert pii.fit(make_docs(["no trigger", None])) is None
    assert pii.personal_data(make_docs([])).collect() == []
