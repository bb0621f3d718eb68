"""Connected components of links, by alternating large and small stars.

Links are dealt into partitions of bounded size and contracted there. If that leaves
more than one partition, rounds follow in which each node points at the smallest id
it knows; they are few, as chains halve. Labels of nodes
are the smallest id reachable. Nulls do not occur; an empty table of links gives an
empty result; repeated links and self links do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import kept

LINKS = 200_000  # of a partition that is contracted


def forest(pairs) -> dict[int, int]:
    """Smallest id of the component of each node of `pairs`."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars; it has some `LINKS` of them."""
    pairs = (
        pair
        for batch in batches
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
    )
    stars = [(x, top) for x, top in forest(pairs).items() if x != top]
    yield pa.RecordBatch.from_arrays(
        [pa.array([s[i] for s in stars], pa.int64()) for i in (0, 1)], ["u", "v"]
    )


def _stars(links: DataFrame) -> DataFrame:
    """One large star and one small star; links are (u, v) with u > v."""
    both = links.union(links.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (
        both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()
    # small star: smaller neighbours and the node itself point at the least of them
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lowest, "u")
    out = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        lowest.select("u", F.col("m").alias("v"))
    )
    return out.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """`id, component_id` for every node of the links (first two columns, long)."""
    links = kept(links.toDF("u", "v").filter("u <> v"))
    partitions = -(-links.count() // LINKS)
    if not partitions:
        return links.toDF("id", "component_id")
    links = kept(links.repartition(partitions).mapInArrow(_contract, "u long, v long"))

    def state(df: DataFrame):
        return df.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()

    before = state(links) if partitions > 1 else None
    while partitions > 1:
        links = kept(_stars(links))
        after = state(links)
        if after == before:
            break
        before = after
    roots = links.select("v", F.col("v").alias("m")).distinct()
    return links.union(roots).toDF("id", "component_id")
