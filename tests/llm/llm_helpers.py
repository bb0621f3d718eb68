"""Fixtures and helpers of these tests; a second conftest.py would hide the first."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

# Names that the operators use inside.
CLASHING = (
    "id chars norm bucket part keys docs n rep label score start end group size block "
    "_slot _start _id _of _row _source top row"
).split()


def clashing(df):
    """`df` with extra columns, some of them null, named like inner ones."""
    for i, name in enumerate(CLASHING):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None if i % 2 else "x").cast("string"))
    return df


def smallest_reachable(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, or from texts that are numbered."""

    def build(rows, source="a"):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", source, len(t) if t is not None else None) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return clashing(spark.createDataFrame(full, schema))

    return build


@pytest.fixture(scope="session")
def prose():
    """Deterministic sentences of invented words."""

    def build(words, seed, vocabulary=400):
        rng = random.Random(seed)
        stock = [f"w{rng.randrange(10**6)}" for _ in range(vocabulary)]
        return " ".join(rng.choice(stock) for _ in range(words))

    return build
