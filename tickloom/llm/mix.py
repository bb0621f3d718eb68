"""Mixing sources to target weights by Pfair scheduling.

A source is a run of blocks of equal volume. With weight w its block i is released
at slot floor(i / w) and due at slot ceil((i + 1) / w); the earliest deadline among
the released blocks gets the slot. So at every slot each source is less than one
block away from its share. Weights are brought to whole numbers without rounding, so
the order repeats after their sum. The driver works out one period, or all slots of
a phase that ends before, a step a block; documents look up the slot of their block.

When a source runs out, a new phase begins: the others go on in their proportions.
Every document is placed once; none is dropped or repeated.

Documents are numbered within a source without a task per source: ids are dealt
into buckets by hash, bucket volumes are summed up first, and windows run per
bucket, whose number follows the source's size.

Defined results: a null source is a source of its own; null text has volume 1 as
the empty one does; rows of one id and source are placed together; a null id comes
first in its bucket. A document longer than a block starts in one block and covers
the next ones, which then hold no start. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_CHARS = 200_000
BUCKET_ROWS = 4_000
FILE_ROWS = 10_000
PAGE_BLOCKS = 4_096  # blocks in one row of the plan
MAX_SOURCES = 10_000


@dataclass(frozen=True)
class Phase:
    """Slots from `begin`; source k owns `slots[k]` of each period, from block `first[k]`.

    A phase shorter than its period has its own slots only.
    """

    begin: int
    period: int
    length: int
    first: dict[str, int]
    slots: dict[str, list[int]]


def whole_weights(weights: dict[str, float], resolution: int | None = None) -> dict[str, int]:
    """Whole numbers in the same proportions; with `resolution`, rounded to add up to about it."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    exact = {k: Fraction(w) for k, w in weights.items()}
    if resolution is None:
        shared = lcm(*(w.denominator for w in exact.values()))
        whole = {k: int(w * shared) for k, w in exact.items()}
    else:
        total = sum(exact.values())
        whole = {k: max(1, round(w * resolution / total)) for k, w in exact.items()}
    shared = gcd(*whole.values())
    return {k: w // shared for k, w in whole.items()}


def one_period(
    weights: dict[str, int], blocks: dict[str, int] | None = None
) -> dict[str, list[int]]:
    """Slots of each source in one period, earliest deadline first, then by name.

    Ends early when a source has had its `blocks`.
    """
    period = sum(weights.values())
    waiting = [(0, k, 0) for k in sorted(weights)]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []  # deadline, source, block
    slots: dict[str, list[int]] = {k: [] for k in weights}
    slot = 0
    while slot < period:
        while waiting and waiting[0][0] <= slot:
            _, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // weights[k]), k, i))
        due, k, i = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a deadline was missed")
        slots[k].append(slot)
        slot += 1
        if blocks and i + 1 == blocks[k]:
            break
        if i + 1 < weights[k]:
            heapq.heappush(waiting, ((i + 1) * period // weights[k], k, i + 1))
    return slots


def _phases(blocks: dict[str, int], weights: dict[str, int]) -> Iterator[Phase]:
    done = dict.fromkeys(blocks, 0)
    begin = 0
    while live := {k: weights[k] for k in blocks if done[k] < blocks[k]}:
        left = {k: blocks[k] - done[k] for k in live}
        slots, period = one_period(live, left), sum(live.values())

        def last(k: str) -> int:
            rounds, rest = divmod(left[k] - 1, live[k])
            return rounds * period + slots[k][rest] + 1

        worked_out = sum(map(len, slots.values()))
        length = worked_out if worked_out < period else min(map(last, live))
        yield Phase(begin, period, length, {k: done[k] for k in live}, slots)
        rounds, rest = divmod(length, period)
        for k in live:
            done[k] += rounds * live[k] + bisect_left(slots[k], rest)
        begin += length


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[Phase]:
    """The schedule of `blocks[k]` blocks per source; at most one phase per source."""
    return list(_phases(blocks, weights))


def schedule(blocks: dict[str, int], weights: dict[str, int]) -> dict[str, list[int]]:
    """The slot of every block of each source."""
    out: dict[str, list[int]] = {k: [] for k in blocks}
    for p in _phases(blocks, weights):
        rounds, rest = divmod(p.length, p.period)
        for k, mine in p.slots.items():
            for begin in range(p.begin, p.begin + rounds * p.period, p.period):
                out[k].extend(begin + s for s in mine)
            begin = p.begin + rounds * p.period
            out[k].extend(begin + s for s in mine[: bisect_left(mine, rest)])
    return out


def volumes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per source and id: `_source, id, size`."""
    return (
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("null")).alias("_source"),
            F.col(id_col).alias("id"),
            (F.coalesce(F.length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        )
        .groupBy("_source", "id")
        .agg(F.sum("size").alias("size"))
    )


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    exponent: float = 0.7,
    block_chars: int = BLOCK_CHARS,
    bucket_rows: int = BUCKET_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """`id, source, block, slot, start` per document; order by `slot, start`.

    `weights` are shares of volume per source; a source they leave out gets the
    smallest one. Without them a source of volume v weighs v ** `exponent`. The
    list of sources goes to the driver: at most `MAX_SOURCES`, else an error.
    """
    spark = docs.sparkSession
    sized = volumes(docs, id_col, text_col, source_col)
    totals = (
        sized.groupBy("_source")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("v"))
        .take(MAX_SOURCES + 1)
    )
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights:
        named = {"null" if k is None else "=" + k: w for k, w in weights.items()}
        chosen = {r["_source"]: named.get(r["_source"], min(named.values())) for r in totals}
    else:
        chosen = {r["_source"]: r["v"] ** exponent for r in totals}
    plan = []
    if totals:
        blocks = {r["_source"]: -(-r["v"] // block_chars) for r in totals}
        for k, slots in schedule(blocks, whole_weights(chosen)).items():
            for page, at in enumerate(range(0, blocks[k], PAGE_BLOCKS)):
                plan.append((k, page, slots[at : at + PAGE_BLOCKS]))
    # at most MAX_SOURCES rows, and 8 bytes a block
    deal = spark.createDataFrame(
        [(r["_source"], -(-r["n"] // bucket_rows)) for r in totals], "_source string, buckets long"
    )
    table = spark.createDataFrame(plan, "_source string, page long, slots array<long>")
    keyed = sized.join(F.broadcast(deal), "_source").withColumn(
        "bucket", F.pmod(F.xxhash64("id"), F.col("buckets"))
    )
    sums = keyed.groupBy("_source", "bucket").agg(F.sum("size").alias("volume"))
    before = Window.partitionBy("_source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.select(
        "_source", "bucket", F.coalesce(F.sum("volume").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("_source", "bucket").orderBy("id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = (
        keyed.join(offsets, ["_source", "bucket"])
        .withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .withColumn("block", F.floor(F.col("start") / block_chars))
        .withColumn("page", F.floor(F.col("block") / PAGE_BLOCKS))
    )
    slot = F.get(F.col("slots"), (F.col("block") % PAGE_BLOCKS).cast("int"))
    source = F.when(F.col("_source") != "null", F.substring("_source", 2, 2**31 - 1))
    return placed.join(F.broadcast(table), ["_source", "page"]).select(
        "id",
        source.alias("source"),
        "block",
        slot.alias("slot"),
        "start",
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` in mixed order: runs of some `FILE_ROWS` are the partitions, sorted."""
    id_col = settings.get("id_col", "doc_id")
    source_col = settings.get("source_col", "source")
    files = max(1, -(-docs.count() // FILE_ROWS))
    order = mix_sources(docs, **settings).select(
        F.col("id").alias("_id"),
        F.col("source").alias("_of"),
        F.col("slot").alias("_slot"),
        F.col("start").alias("_start"),
    )
    # as one column, so that no name of `docs` meets one of the order
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = F.col("_row")[id_col].eqNullSafe(F.col("_id")) & F.col("_row")[source_col].eqNullSafe(F.col("_of"))
    ranged = rows.join(order, same).repartitionByRange(files, "_slot", "_start")
    return ranged.sortWithinPartitions("_slot", "_start").select("_row.*")
