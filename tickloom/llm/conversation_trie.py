"""Trie of the turns that conversations begin with, and what sharing them would save.

`rebuilt` gives the conversations: each begins with some turns of the conversation that
leads its group of 20. `prefix_trie` turns them into nodes: every distinct sequence of
first turns is one, from the textless root on.

Steps: equal conversations are counted together; the distinct ones, 16 bytes a turn, are
put in order and cut into ranges. Each range links neighbours by their common prefix and
builds its nodes by union-find from the deepest link on (`prefix_forest.py`). Nodes shared
by ranges are contracted, `FAN_IN` ranges at a time, until one is left. A row holds at most
`SEGMENT` turns: a longer conversation goes on in a segment that is grouped by all turns
before it; segments are solved from the last on and hang their sums below the node where
they begin. Texts are only read to number, hash and count; no step holds a conversation
or a group of equal ones.

Defined results: null ids are no conversations; null role and text are empty. Turns stand
in order of turn (null first), then role, then text; repeated rows are turns of their own.
An empty table gives no node. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import kept
from tickloom.llm.prefix_forest import Node, Sequence, common_turns, forest, merge

SEGMENT = 1_024  # turns of a row
RANGE_TURNS = 100_000  # of a range, about
FAN_IN = 64  # ranges contracted at once; each hands on at most 2 * SEGMENT nodes
GROUP = 20  # fixed value: conversations that begin alike
LED = 4  # fixed value: fewer than this many turns are taken over
ROOT = bytes(16)

KEYED = "conv_id long, digest string, words int, pos long"
NODES = (
    "block int, group binary, depth int, id binary, parent_id binary, parent long, conv long, "
    "n long, n_children long, n_leaves long, saved long, ends string, words long, "
    "on_left boolean, on_right boolean"
)
FIELDS = [field.split(" ")[0] for field in NODES.split(", ")]
TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
KINDS = [TYPES[field.split(" ")[1]] for field in NODES.split(", ")]
NO_END = hashlib.sha256(b"").hexdigest()


def numbered(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """`rows` (distinct ranges of `key` and `order`, some columns) with `pos`, the place in its key.

    Ranges cut long keys, so no task holds one: places go on from range to range, by the
    number of rows that each range has of its first and last key.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in order)
    ranged = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).drop(*order)
    ranged = kept(ranged.select(key, *[c for c in ranged.columns if c != key]))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, n_last, n = None, None, 0, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            first = int(ids[0]) if first is None else first
            same = len(ids) - int(np.searchsorted(ids, ids[-1]))
            n_last = same + (n_last if last == ids[-1] and same == len(ids) else 0)
            last, n = int(ids[-1]), n + len(ids)
        if n:
            row = [TaskContext.get().partitionId(), first, last, n_last]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], ["p", "a", "b", "n"])

    # four numbers a range
    found = sorted(ranged.select(key).mapInArrow(ends, "p long, a long, b long, n long").collect())
    before: dict[int, int] = {}
    last, n = None, 0
    for p, a, b, rows_of_last in found:
        before[p] = n if a == last else 0
        n = rows_of_last + (before[p] if a == b else 0)
        last = b

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, before.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            begins = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            pos = np.arange(len(ids)) - np.repeat(begins, np.diff(np.append(begins, len(ids))))
            if last is None or last == ids[0]:
                head = begins[1] if len(begins) > 1 else len(ids)
                pos[:head] += n
            last, n = ids[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pos, pa.int64())], [*batch.schema.names, "pos"]
            )

    names = ranged.columns
    kinds = dict(part.split(" ", 1) for part in schema.replace("`", "").split(", "))
    return ranged.mapInArrow(number, ", ".join(f"{c} {kinds[c]}" for c in names) + ", pos long")


def _turns(conversations: DataFrame) -> DataFrame:
    """`conv_id, digest, words, pos` of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    pair = F.concat_ws(":", F.length(role).cast("string"), role, text)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.left(F.sha2(pair, 256), F.lit(32)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    return numbered(rows, "conv_id", ["turn", "role", "text"])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns `conv_id, d, digest, words`, and `conv_id, turns` of every conversation.

    Conversation c begins with the first crc32(c) mod 4 turns of c - c mod 20, followed by
    its own after as many.
    """
    turns = kept(_turns(conversations))
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("own", F.col("own") + 1)
    led = (F.crc32(F.col("conv_id").cast("string")) % LED).alias("led")
    sizes = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), led, "own")
    leaders = sizes.filter("conv_id = base").select("base", F.col("own").alias("there"))
    taken = F.least("led", F.coalesce("there", F.lit(0))).alias("taken")
    convs = kept(
        sizes.join(leaders, "base", "left")
        .select("conv_id", "base", "led", "own", taken)
        .withColumn("turns", F.col("taken") + F.greatest(F.col("own") - F.col("led"), F.lit(0)))
    )
    heads = turns.filter(f"conv_id % {GROUP} = 0 and pos < {LED}").withColumnRenamed("conv_id", "base")
    begun = convs.join(heads, "base").filter("pos < taken").select("conv_id", F.col("pos").alias("d"), "digest", "words")
    shift = convs.filter("own > led").select("conv_id", "led", "taken")
    own = turns.join(shift, "conv_id").filter("pos >= led").select(
        "conv_id", (F.col("pos") - F.col("led") + F.col("taken")).alias("d"), "digest", "words"
    )
    return begun.unionByName(own), convs.select("conv_id", "turns")


def _member_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each node, which come in order."""
    node, running = None, None
    for batch in batches:
        nodes, hashes = [], []
        for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at == node:
                running.update(b",%d" % conv)
                continue
            if node is not None:
                nodes.append(node)
                hashes.append(running.hexdigest())
            node, running = at, hashlib.sha256(b"%d" % conv)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], ["id", "ends"])
    if node is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([running.hexdigest()], pa.string())], ["id", "ends"]
        )


def _distinct(segments: DataFrame, heads: DataFrame | None) -> DataFrame:
    """Equal segments of a level together, with the hash of the conversations that end there."""
    id_ = F.unhex(F.left(F.sha2(F.concat("group", "key"), 256), F.lit(32)))
    segments = segments.withColumn("id", id_)
    ends = (
        segments.filter("is_last")
        .select("id", "conv_id")
        .repartition("id")
        .sortWithinPartitions("id", "conv_id")
        .mapInArrow(_member_hashes, "id binary, ends string")
    )
    found = (
        segments.groupBy("group", "key", "id", "words")
        .agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
        .join(ends, "id", "left")
    )
    if heads is None:
        return kept(found.withColumn("head", F.lit(None).cast("long")))
    return kept(found.join(heads, "group"))


def _edge_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last sequence of a range."""
    ends = None
    for batch in batches:
        if batch.num_rows:
            ends = [ends[0] if ends else batch.slice(0, 1), batch.slice(batch.num_rows - 1)]
    if ends:
        columns = [pa.array([TaskContext.get().partitionId()], pa.int64())]
        columns += [pa.array([e.column(i)[0].as_py()], pa.binary()) for e in ends for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["p", "group_a", "key_a", "group_b", "key_b"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth that neighbouring ranges share."""
    for batch in batches:
        p, *keys = (c.to_pylist() for c in batch.columns)
        depth = [-1 if k[0] is None else common_turns(*k) for k in zip(*keys)]
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(depth, pa.int64())], ["p", "depth"])


def _boundaries(ranged: DataFrame) -> dict[int, tuple[int, int, int]]:
    """Of each range that has rows: its number, and what it shares with the ones before and after.

    Two numbers a range reach the driver; keys do not.
    """
    order = Window.orderBy("p")  # a row per range
    pairs = (
        ranged.select("group", "key")
        .mapInArrow(_edge_keys, "p long, group_a binary, key_a binary, group_b binary, key_b binary")
        .select("p", F.lag("group_b").over(order), F.lag("key_b").over(order), "group_a", "key_a")
    )
    found = sorted(map(tuple, pairs.mapInArrow(_shared, "p long, depth long").collect()))
    after = [depth for _, depth in found[1:]] + [-1]
    return {p: (i, left, right) for i, ((p, left), right) in enumerate(zip(found, after))}


def _batch(block: int, nodes: list[Node]) -> pa.RecordBatch:
    columns = list(zip(*nodes)) or [[]] * (len(FIELDS) - 1)
    columns = [[block] * len(nodes), *columns]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], FIELDS)


def _merged(of: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        rows = zip(*(c.to_pylist() for c in table.columns))
        first, last = block * FAN_IN, min((block + 1) * FAN_IN, of) - 1
        nodes = merge([(Node(*row[1:]), row[0] == first, row[0] == last) for row in rows])
        return pa.Table.from_batches([_batch(block, nodes)])

    return run


def _nodes(sequences: DataFrame) -> DataFrame:
    """`NODES` of all groups of a level, closed, with the parent's smallest member."""
    size = sequences.agg(F.sum(F.length("key")), F.count(F.lit(1))).first()
    ranges = max(1, ((size[0] or 0) // 16 + size[1]) // RANGE_TURNS)
    columns = ["group", "key", "words", "n", "conv", "ends", "head", "n_children", "n_leaves", "saved"]
    ranged = kept(
        sequences.select(*columns)
        .repartitionByRange(int(ranges), "group", "key")
        .sortWithinPartitions("group", "key")
    )
    bounds = _boundaries(ranged)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [Sequence(*row) for b in batches for row in zip(*(c.to_pylist() for c in b.columns))]
        if rows:
            block, left, right = bounds[TaskContext.get().partitionId()]
            nodes = forest(rows, left, right)
            for i in range(0, len(nodes), 20_000):
                yield _batch(block, nodes[i : i + 20_000])

    nodes = kept(ranged.mapInArrow(build, NODES))
    shared = F.col("on_left") | F.col("on_right")
    closed, opened, blocks = nodes.filter(~shared), nodes.filter(shared), len(bounds)
    late = None
    while blocks > 1:
        grouped = opened.groupBy(F.floor(F.col("block") / FAN_IN).alias("merged"))
        nodes = kept(grouped.applyInArrow(_merged(blocks), NODES))
        some, opened = nodes.filter(~shared), nodes.filter(shared)
        late = some if late is None else late.unionByName(some)
        blocks = -(-blocks // FAN_IN)
    if late is None:
        return closed
    # only nodes between ranges are parents that a range did not know
    above = late.select(F.col("id").alias("parent_id"), F.col("conv").alias("found"))
    every = closed.unionByName(late)
    known, unknown = every.filter("parent_id is null"), every.filter("parent_id is not null")
    settled = unknown.join(above, "parent_id").withColumn("parent", F.col("found"))
    return known.unionByName(settled.select(*known.columns))


def prefix_trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per node, from turns `conv_id, d, digest, words` and `conv_id, turns`."""
    digests = F.array_join(F.transform("all", lambda t: t["digest"]), "")
    segments = (
        turns.groupBy("conv_id", F.floor(F.col("d") / segment).cast("int").alias("level"))
        .agg(F.array_sort(F.collect_list(F.struct("d", "digest", "words"))).alias("all"))
        .select("conv_id", "level", F.unhex(digests).alias("key"), F.transform("all", lambda t: t["words"]).alias("words"))
    )
    final = F.greatest(F.floor((F.col("turns") - 1) / segment), F.lit(0)).cast("int").alias("final")
    ends = convs.select("conv_id", final)
    empty = F.array().cast("array<int>")
    segments = kept(
        ends.join(segments, "conv_id", "left").select(
            "conv_id",
            F.coalesce("level", F.lit(0)).alias("level"),
            F.coalesce("key", F.lit(b"")).alias("key"),
            F.coalesce("words", empty).alias("words"),
            (F.coalesce("level", F.lit(0)) == F.col("final")).alias("is_last"),
        )
    )
    levels = (segments.agg(F.max("level")).first()[0] or 0) + 1
    steps: list[DataFrame] = []
    group = segments.filter("level = 0").withColumn("group", F.lit(ROOT))
    heads = None
    for level in range(levels):  # one, unless conversations are longer than a segment
        step = _distinct(group, heads)
        steps.append(step)
        if level + 1 < levels:
            heads = step.select(F.col("id").alias("group"), F.col("conv").alias("head"))
            onward = group.filter("not is_last").select(
                "conv_id", F.unhex(F.left(F.sha2(F.concat("group", "key"), 256), F.lit(32))).alias("group")
            )
            group = kept(segments.filter(F.col("level") == level + 1).join(onward, "conv_id"))
    below = None
    out = None
    for level in range(levels - 1, -1, -1):
        step = steps[level]
        if below is None:
            step = step.withColumns({c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved")})
        else:
            step = step.join(below, "id", "left").fillna(0, ["n_children", "n_leaves", "saved"])
        nodes = _nodes(step)
        if level:
            nodes = kept(nodes)
            below = nodes.filter("depth = 0").select(
                F.col("group").alias("id"), "n_children", "n_leaves", "saved"
            )
            nodes = nodes.filter("depth > 0")
        part = nodes.select(
            F.col("conv").alias("conv_id"),
            (F.col("depth") + level * segment).cast("long").alias("depth"),
            F.col("parent").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            "n_children",
            "n_leaves",
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_END)).alias("ends_sha256"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """`conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`."""
    return prefix_trie(*rebuilt(conversations))
