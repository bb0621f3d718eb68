from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import make_docs, prose  # noqa: F401

from tickloom.llm import grams, gru
from tickloom.llm.queries import op3_toxicity
from tickloom.llm.toxicity import drop_toxic, fit, score, toxicity


def text_of(texts, shape=gru.Shape()):
    return gru.Text(*grams.text_bytes(pa.array(texts, pa.string())), shape)


def test_windows_cover_every_word():
    shape = gru.Shape(window=8, stride=4)
    for n in (0, 1, 7, 8, 9, 12, 13, 100):
        words = [f"w{i}" for i in range(n)]
        text = text_of(["x y z", " ".join(words), ""], shape)
        mine = text.windows[text.owner == 1][text.mask[text.owner == 1]]
        hashes = {int(text.hash[i]) for i in mine}
        assert len(hashes) == n
        assert text.mask.sum(axis=1).max() <= 8


def test_gradients_match_differences():
    shape = gru.Shape(window=6, stride=3, hidden=3, attention=2, word_dim=2, gram_dim=2, gram_buckets=64)
    text = text_of(["the cat sat on a mat today", "dog", "cat dog cat"], shape)
    net = gru.Network.random(shape, np.sort(text.hash[:3]))
    for w in net.weights.values():
        w *= 3
    pick, target = np.arange(len(text.windows)), np.array([1, 0, 0, 1][: len(text.windows)], np.float32)
    target = np.resize(target, len(pick))
    _, grad = gru.gradients(net, text, pick, target)
    for name, g in grad.items():
        flat = net.weights[name].reshape(-1)
        at = int(np.abs(g).argmax())
        kept = flat[at]
        losses = []
        for step in (1e-2, -1e-2):
            flat[at] = kept + step
            losses.append(gru.gradients(net, text, pick, target)[0])
        flat[at] = kept
        assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(g.reshape(-1)[at], rel=0.05, abs=2e-3)


def test_scores_do_not_depend_on_neighbours(prose):
    shape = gru.Shape()
    texts = [prose(n, n) for n in (3, 64, 65, 200, 1)] + ["", "!?"]
    net = gru.Network.random(shape, np.zeros(0, np.uint64))
    together = net.scores(text_of(texts))
    alone = [net.scores(text_of([t]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


@pytest.fixture(scope="module")
def corpus(spark, make_docs, prose):
    rng = np.random.default_rng(9)
    rows, marks = [], []
    for i in range(500):
        words = prose(int(rng.integers(20, 220)), i, 60).split()
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words[int(rng.integers(len(words)))] = str(rng.choice(["vilest", "vileness", "rotten"]))
        rows.append((i, " ".join(words)))
        marks.append((i, 0, int(toxic)))
    rows += [(600, None), (601, ""), (602, "vilest"), (602, "vilest"), (None, "some words")]
    rows += [(603, prose(5_000, 7, 60) + " rotten vilest vileness"), (604, prose(5_000, 8, 60))]
    labels = spark.createDataFrame(
        marks + [(700, None, 1), (600, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int"
    )
    return make_docs(rows), labels


def test_held_out_accuracy_and_long_texts(corpus):
    docs, labels = corpus
    out = toxicity(docs, labels).collect()
    assert len(out) == docs.count()
    right = 0
    for r in out:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] == held and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.7)
        if held and r["doc_id"] < 500:
            right += r["predicted"] == int(r["doc_id"] % 5 == 0)
    held = sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in range(500))
    assert right >= 0.97 * held
    scores = {r["doc_id"]: r["score"] for r in out}
    assert scores[603] >= 0.7 > scores[604]
    left = drop_toxic(docs, labels)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} >= {600, 601, 604, None}


def test_each_row_is_judged_by_its_own_text(corpus, make_docs):
    docs, labels = corpus
    texts = {r["doc_id"]: r["text"] for r in docs.filter("doc_id in (603, 604)").collect()}
    rows = [(9_000, texts[603]), (9_000, texts[604]), (None, texts[603]), (None, texts[604])]
    left = drop_toxic(docs.unionByName(make_docs(rows)), labels)
    found = left.filter("doc_id = 9000 or doc_id is null and text <> 'some words'").collect()
    assert {(r["doc_id"], r["text"]) for r in found} == {(9_000, texts[604]), (None, texts[604])}


def test_without_both_labels_the_share_is_the_score(spark, make_docs):
    docs = make_docs(["a", None, "b"])
    schema = "doc_id long, toxic int"
    for rows, want in (([], 0.0), ([(0, 0), (2, 0)], 0.0), ([(0, 1), (2, 1)], 1.0)):
        model = fit(docs, spark.createDataFrame(rows, schema))
        assert model == want
        assert {r["score"] for r in score(docs, model).collect()} == {want}


def test_empty_table(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity(make_docs([]), labels).collect() == []


def test_accuracy_on_the_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op3_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right >= 0.9 * len(rows)
