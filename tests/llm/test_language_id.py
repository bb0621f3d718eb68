"""Language of texts: code lengths against a slow coder, and accuracy on held-out documents."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import clashing, make_docs  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm import grams, ppm
from tickloom.llm.language_id import UNKNOWN, fit, languages, predict

SF = "/root/testdata/sf0.001"


class SlowTree:
    """A context tree as nested dictionaries, coded byte by byte."""

    def __init__(self, texts):
        self.seen = defaultdict(Counter)
        for text in texts:
            padded = bytes(ppm.ORDER) + text
            for i in range(ppm.ORDER, len(padded)):
                for order in range(ppm.ORDER + 1):
                    self.seen[padded[i - order : i]][padded[i]] += 1

    def byte(self, context, symbol):
        after = self.seen.get(context)
        bits = 0
        if after:
            total = sum(after.values()) + len(after)
            if symbol in after:
                return round(math.log2(total / after[symbol]) * ppm.BIT)
            bits = round(math.log2(total / len(after)) * ppm.BIT)
        return bits + (self.byte(context[1:], symbol) if context else 8 * ppm.BIT)

    def length(self, text):
        padded = bytes(ppm.ORDER) + text
        return sum(self.byte(padded[i - ppm.ORDER : i], padded[i]) for i in range(ppm.ORDER, len(padded)))


def as_bytes(texts):
    return grams.text_bytes(pa.array(texts, pa.binary()))


@pytest.mark.parametrize("piece", [1, 7, 2_000_000])
def test_code_lengths_are_those_of_a_slow_coder(monkeypatch, piece):
    monkeypatch.setattr(ppm, "PIECE", piece)
    rng = random.Random(5)
    kinds = ["abc ", "abd é", "xyz"]
    texts = [
        ["".join(rng.choice(kind) for _ in range(rng.randrange(0, 60))).encode() for _ in range(12)]
        for kind in kinds
    ]
    scorer = ppm.Scorer(ppm.fit([as_bytes(t) for t in texts]))
    probes = [b"", b"a", b"abcabd", "éé zz".encode(), b"\x00\xff", b"cab abc q", *texts[0], b"", b""]
    found = scorer.texts(*as_bytes(probes))
    slow = [SlowTree(t) for t in texts]
    assert found.tolist() == [[tree.length(p) for tree in slow] for p in probes]


def test_table_finds_known_numbers_and_no_others():
    rng = np.random.default_rng(1)
    known = np.unique(rng.integers(0, 2**40, 5_000, dtype=np.uint64))
    table = ppm.Table(known)
    assert (table.find(known) == np.arange(len(known))).all()
    others = np.setdiff1d(rng.integers(0, 2**40, 5_000, dtype=np.uint64), known)
    assert (table.find(others) == -1).all()
    assert (ppm.Table(known[:0]).find(others) == -1).all()


def test_whole_query_equals_slow_trees(spark, make_docs):  # noqa: F811
    docs = make_docs(
        [(i, t) for i, t in enumerate(["the thing and", "there an other", "le la les", "une elle est"] * 6)]
    ).withColumn("lang", F.when(F.col("text").startswith("t"), "en").otherwise("fr"))
    model = fit(docs)
    trained = [r for r in docs.collect() if not in_held_out(r["doc_id"])]
    slow = {
        lang: SlowTree([r["text"].encode() for r in trained if r["lang"] == lang]) for lang in ("en", "fr")
    }
    probes = make_docs([(100, "the other"), (101, "elle"), (102, "zzzz qq")])
    for row in predict(probes, model).collect():
        text = {r["doc_id"]: r["text"] for r in probes.collect()}[row["doc_id"]].encode()
        bits = {lang: tree.length(text) / ppm.BIT for lang, tree in slow.items()}
        best = min(sorted(bits), key=bits.get)
        assert row["lang_pred"] == best
        assert row["score"] == pytest.approx(1 / sum(2 ** (bits[best] - b) for b in bits.values()))


def in_held_out(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_documents_get_their_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = languages(docs).withColumnRenamed("lang_pred", "p").join(docs, "doc_id").collect()
    assert len(found) == docs.count()
    unseen = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == in_held_out(r["doc_id"]) for r in found)
    assert sum(r["p"] == r["lang"] for r in unseen) >= 0.95 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_labels_of_held_out_documents_are_not_learned(spark, make_docs):  # noqa: F811
    docs = make_docs([(i, "ab cd" if in_held_out(i) else "ef gh") for i in range(40)])
    docs = docs.withColumn("lang", F.when(F.col("text") == "ab cd", "xx").otherwise("yy"))
    assert {r["lang_pred"] for r in languages(docs).collect()} == {"yy"}


def test_odd_rows(spark, make_docs):  # noqa: F811
    rows = [(0, "hello there"), (2, None), (3, ""), (4, "12 .. 34"), (5, "é"), (6, "x" * 300_000), (6, "hello there")]
    docs = make_docs(rows + [(None, "hello there"), (7, "no language")])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 7, None).otherwise(F.col("lang")))
    found = {(r["doc_id"], r["lang_pred"]) for r in languages(docs).collect()}
    assert found == {
        (0, "en"), (2, UNKNOWN), (3, UNKNOWN), (4, UNKNOWN), (5, "en"), (6, "en"), (None, "en"), (7, "en")
    }
    assert languages(docs).count() == docs.count()
    scores = {r["doc_id"]: r["score"] for r in languages(docs).collect()}
    assert scores[2] == scores[3] == scores[4] == 0.0


def test_empty_table_and_no_languages(spark, make_docs):  # noqa: F811
    empty = make_docs([(0, "a")]).filter("doc_id < 0")
    assert languages(empty).collect() == []
    none = make_docs([(0, "a b"), (2, "c")]).withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in languages(none).collect()} == {(UNKNOWN, 0.0)}
