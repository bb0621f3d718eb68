from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_helpers import make_docs  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import grams, pack
from tickloom.llm.queries import tokenizer_spec

SPEC = tokenizer_spec()
TEXTS = [
    None,
    "",
    " ",
    "  ",
    "a",
    "two  spaces   and\n\n lines \t tabs \r\n  end  ",
    "\n x y  z 　w \x85v \x1c u",
    "It's we'll THEY'RE 1234 56,78 ... !!! é日本語 😀😀",
    "<|endoftext|> a<|endoftext|>b <|endoftext",
    "naïve café " * 700,
    "x" * 20_000,
    "word " * 3_000,
    "\0\0 \x07",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(SPEC)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_equal_the_tokenizer_on_whole_texts(tokenizer):
    rng = np.random.default_rng(3)
    stock = [" ", "  ", "\n", "\t", " ", " ", "a", "é", "'s", "12", "!", "ab cd", "漢"]
    more = ["".join(rng.choice(stock, rng.integers(1, 30))) for _ in range(1_500)]
    texts = [t or "" for t in TEXTS] + more
    import pyarrow as pa

    raw, offsets = grams.text_bytes(pa.array(texts))
    ids, at = pack.Encoder(SPEC).ids(raw, offsets)
    for text, a, b in zip(texts, at[:-1], at[1:]):
        assert [*ids[a:b].tolist(), 2] == whole(tokenizer, text), repr(text)


def test_a_full_cache_changes_nothing(tokenizer, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(pack, "CACHED_WORDS", 40)
    encoder = pack.Encoder(SPEC)
    for seed in range(5):
        texts = [f"w{seed} v{i} common" for i in range(30)]
        ids, at = encoder.ids(*grams.text_bytes(pa.array(texts)))
        for text, a, b in zip(texts, at[:-1], at[1:]):
            assert [*ids[a:b].tolist(), 2] == whole(tokenizer, text)


def test_pieces_and_places(make_docs, tokenizer):
    rows = [(50 - i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "no id")]
    out = pack.pack_documents(make_docs(rows), SPEC, capacity=64, group_rows=5)
    packed = out.collect()
    texts = dict(rows)
    for doc in texts:
        ids = whole(tokenizer, texts[doc])
        pieces = sorted((r for r in packed if r["doc_id"] == doc), key=lambda r: r["piece"])
        times = sum(d == doc for d, _ in rows)
        assert len(pieces) == times * max(1, -(-len(ids) // 64))
        for r in pieces:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part) and bytes(r["ids"]) == part
        lengths = [r["length"] for r in pieces[:: times]]
        assert sum(lengths) == len(ids) and all(n == 64 for n in lengths[1:])
    places = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 64
    joined = {r["sequence_id"]: r for r in pack.sequences(out).collect()}
    for r in packed:
        ids = bytes(joined[r["sequence_id"]]["ids"])
        assert ids[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])


def slow_place(lengths, capacity):
    """The same choice by trying every open bin."""
    gaps = []
    out = []
    for size in lengths:
        def cost(new):
            return sum(new.count(g) ** 2 for g in set(new) if g)

        options = sorted(
            (cost([*gaps[:b], g - size, *gaps[b + 1 :]]), g) for b, g in enumerate(gaps) if g >= size
        )
        if options:
            gap = options[0][1]
            gaps[gaps.index(gap)] -= size
        else:
            gap = capacity
            gaps.append(capacity - size)
        out.append(gap)
    return out


def test_placement_minimises_the_sum_of_squares():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.sort(rng.integers(1, 33, 60))[::-1]
        _, offsets = pack.place(lengths, 32)
        assert (32 - offsets).tolist() == slow_place(lengths.tolist(), 32)


def test_few_sequences_are_wasted():
    lengths = np.sort(np.random.default_rng(1).integers(1, 1_025, 10_000))[::-1]
    bins, _ = pack.place(lengths, 1_024)
    assert bins.max() + 1 <= 1.01 * lengths.sum() / 1_024


def test_groups_keep_to_themselves(make_docs):
    docs = make_docs([f"text {i}" for i in range(40)])
    out = pack.pack_documents(docs, SPEC, group=F.pmod("doc_id", F.lit(2))).collect()
    for r in out:
        assert r["sequence_id"] >> 24 == r["doc_id"] % 2


def test_empty_table(make_docs):
    assert pack.pack_documents(make_docs([]), SPEC).collect() == []


def test_sequences_follow_the_numbers_of_the_files(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"text {i}") for i in range(40)]).repartitionByRange(4, "doc_id")
    docs.write.parquet(str(tmp_path / "mix"))
    docs = spark.read.parquet(str(tmp_path / "mix"))
    group = pack.neighbours(docs)
    rows = pack.pack_documents(docs, tokenizer_spec(), group=group).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r["doc_id"])
    runs = [sorted(by_sequence[k]) for k in sorted(by_sequence)]
    assert len(runs) == 4 and sum(runs, []) == list(range(40))
