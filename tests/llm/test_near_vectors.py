from __future__ import annotations

import numpy as np
import pytest
from llm_helpers import clashing, smallest_reachable  # noqa: F401

from tickloom.llm import near_vectors as N


def expected(rows, threshold):
    def fine(v):
        return v is not None and any(v) and all(x is not None and np.isfinite(x) for x in v)

    usable = {i: (l, np.float64(v)) for i, l, v in rows if i is not None and l is not None and fine(v)}
    links = []
    ids = sorted(usable)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            (la, x), (lb, y) = usable[a], usable[b]
            if la == lb and len(x) == len(y):
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links.append((a, b))
    every = {i for i, _, _ in rows if i is not None}
    tops = smallest_reachable(every, links)
    return {i: (sum(i in p for p in links), tops[i], tops[i] == i) for i in every}


def got(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def table(spark, rows):
    schema = "vec_id long, label int, embedding array<float>"
    return clashing(spark.createDataFrame(rows, schema).drop("x"))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = []
    for label in (1, 2, 3):
        centres = rng.standard_normal((12, 24))
        for _ in range(90):
            v = centres[rng.integers(12)] + rng.standard_normal(24) * rng.choice([0.05, 0.2, 0.3])
            out.append((label, [float(np.float32(x)) for x in v]))
    out += [(1, out[0][1])] * 5 + [(1, [float(x) * 2 for x in out[0][1]])]  # copies
    out += [(None, out[0][1]), (1, None), (1, []), (1, [0.0] * 24), (2, [float("nan")] * 24)]
    out += [(2, [None] + [1.0] * 23), (2, [float("inf")] * 24), (1, [1.0, 0.0]), (1, [1.0, 0.1])]
    out += [(3, [1e-30] * 24), (3, [1e30] * 24)]
    return [(5_000 - 7 * i, label, v) for i, (label, v) in enumerate(out)]


def test_links_match_all_pairs(spark, rows):
    assert got(N.near_vectors(table(spark, rows))) == expected(rows, 0.93)


def test_small_tiles_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(N, "TILE", 16)
    monkeypatch.setattr(N, "PAIRS", 50)
    assert got(N.near_vectors(table(spark, rows), 0.8)) == expected(rows, 0.8)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 1, [2.0, 4.0]), (None, 1, [1.0, 2.0])]
    out = got(N.near_vectors(table(spark, rows)))
    assert out == {1: (1, 1, True), 2: (1, 1, False), None: (0, None, True)}


def test_empty_table(spark, rows):
    assert N.near_vectors(table(spark, rows).limit(0)).collect() == []


def test_pairs_are_dropped_only_below_the_threshold():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((300, 20)) * np.linspace(3, 0.1, 20)
    _, axes = np.linalg.eigh(a.T @ a)
    found = set()
    for i, j in N.linked_pairs(a, a, axes[:, ::-1], 0.9, True):
        found |= set(zip(i.tolist(), j.tolist()))
    u = a / np.linalg.norm(a, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    assert found == {(i, j) for i in range(300) for j in range(i + 1, 300) if near[i, j]}
