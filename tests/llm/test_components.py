from __future__ import annotations

import random

import pytest
from llm_helpers import smallest_reachable  # noqa: F401

from tickloom.llm import components as C


@pytest.mark.parametrize("size", [7, 200_000])
def test_components_equal_union_find(spark, monkeypatch, size):
    monkeypatch.setattr(C, "LINKS", size)
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)]  # a chain
    links += [(100, 100 + i) for i in range(1, 30)] + [(5, 5), (300, 299), (300, 299)]
    links += [(rng.randrange(400, 480), rng.randrange(400, 480)) for _ in range(60)]
    ids = {x for pair in links if pair[0] != pair[1] for x in pair}
    want = smallest_reachable(ids, [p for p in links if p[0] != p[1]])
    df = spark.createDataFrame(links, "a long, b long")
    got = [(r["id"], r["component_id"]) for r in C.components(df).collect()]
    assert sorted(got) == sorted(want.items())


def test_no_links(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []
