"""Near-duplicate vectors: PCA-ordered tiled comparison.

Unit vectors are rotated so that their leading dimensions hold most of their norm.
Vectors of one label are cut along the first of them into tiles; two tiles are
compared only if their ranges are near enough for any link. Within a pair of tiles
the products of leading dimensions come first; a pair is dropped as soon as what it
has plus the product of the two suffix norms (Cauchy-Schwarz) cannot reach the
threshold. What is left is decided by the cosine of the vectors as given.

Equal vectors are compared once and carry their number. A pair of tiles returns
link counts and a spanning forest, never its pairs. A label may be as large as it
likes: tiles are bounded, and a crowded range is dealt over several by hash.

Defined results: a null label, a null, empty or zero vector, and one with a null or
non-finite component link with nothing. Vectors of different lengths do not link.
Repeated rows (same id and vector) count as one vector. A null id links with
nothing. An empty table gives an empty result. Extra columns are ignored. More than
`MAX_LENGTHS` (64) different vector lengths are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import kept
from tickloom.llm.components import components

TILE = 1_024
BINS = 256
STEP = 8  # dimensions accumulated at a time
PAIRS = 50_000  # surviving pairs worked on at a time
MAX_LENGTHS = 64  # different vector lengths; their rotations go to the driver
SLACK = 1e-9  # rounding of bounds


def comparable(vector: Column) -> Column:
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    nonzero = F.exists(vector, lambda x: x != 0)
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(nonzero, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list array without nulls, all of one length, as doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # neither overflow nor underflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _by_length(column: pa.Array):
    lengths = np.diff(column.offsets.to_numpy())
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield int(length), rows, _matrix(column.take(pa.array(rows)))


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the principal axes, largest variance about zero first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, rows in _by_length(batch.column(0)):
                rows = _unit(rows)
                total[length] = total.get(length, 0) + rows.T @ rows
        for length, m in total.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(m.size, length), pa.int32()),
                    pa.array(np.arange(m.size), pa.int32()),
                    pa.array(m.ravel()),
                ],
                ["length", "cell", "value"],
            )

    lengths = vectors.select(F.size("vector").alias("n")).distinct().take(MAX_LENGTHS + 1)
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"more than {MAX_LENGTHS} vector lengths")
    cells = (
        vectors.select("vector")
        .mapInArrow(moments, "length int, cell int, value double")
        .groupBy("length", "cell")
        .agg(F.sum("value").alias("value"))
    )
    out = {}
    table = cells.toArrow()
    for row in lengths:
        mine = table.filter(pa.compute.equal(table["length"], row["n"])).sort_by("cell")
        moment = mine["value"].to_numpy().reshape(row["n"], row["n"])
        _, axes = np.linalg.eigh(moment)
        out[row["n"]] = np.ascontiguousarray(axes[:, ::-1])
    return out


def _leading(vectors: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """`vectors` with `x`, the first rotated coordinate of the unit vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros(batch.num_rows)
            for length, index, rows in _by_length(batch.column(batch.schema.names.index("vector"))):
                x[index] = _unit(rows) @ axes[length][:, 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(x)], [*batch.schema.names, "x"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, fields + ", x double")


def _tiles(placed: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """Vectors with their tile (`strip`, `sub`), and pairs of tiles to compare."""
    key = ["label", "length"]
    bins = placed.withColumn("bin", F.floor((F.col("x") + 1) * (BINS / 2)).cast("int"))
    counts = bins.groupBy(*key, "bin").agg(F.count(F.lit(1)).alias("n"))
    # at most BINS + 1 rows per label and length
    total = F.expr(
        "aggregate(filter(_all, b -> b.bin < bin), 0L, (s, b) -> s + b.n)"
    )
    strips = (
        counts.groupBy(*key)
        .agg(F.collect_list(F.struct("bin", "n")).alias("_all"))
        .select(*key, "_all", F.explode("_all").alias("_one"))
        .select(*key, "_all", F.col("_one.bin").alias("bin"), F.col("_one.n").alias("n"))
        .select(
            *key,
            "bin",
            F.floor(total / TILE).alias("strip"),
            F.ceil(F.col("n") / TILE).alias("subs"),
        )
    )
    tiled = bins.join(strips, [*key, "bin"]).withColumn(
        "sub", F.pmod(F.xxhash64("id"), F.col("subs"))
    )
    tiles = tiled.groupBy(*key, "strip", "sub").agg(
        F.min("x").alias("low"), F.max("x").alias("high")
    )
    a, b = tiles.alias("a"), tiles.alias("b")
    near = (F.col("b.low") - F.col("a.high") <= reach) & (F.col("a.low") - F.col("b.high") <= reach)
    ordered = F.struct("a.strip", "a.sub") <= F.struct("b.strip", "b.sub")
    same = (F.col("a.label") == F.col("b.label")) & (F.col("a.length") == F.col("b.length"))
    pairs = a.join(b, same & near & ordered).select(
        F.col("a.label").alias("label"),
        F.col("a.length").alias("length"),
        F.array(
            F.struct("a.strip", "a.sub", F.lit(0).alias("side")),
            F.struct("b.strip", "b.sub", F.lit(1).alias("side")),
        ).alias("_sides"),
        F.xxhash64("a.label", "a.length", "a.strip", "a.sub", "b.strip", "b.sub").alias("pair"),
        ((F.col("a.strip") == F.col("b.strip")) & (F.col("a.sub") == F.col("b.sub"))).alias("own"),
    )
    sides = pairs.select("label", "length", "pair", "own", F.explode("_sides").alias("_s")).select(
        "label", "length", "pair", "own", "_s.strip", "_s.sub", "_s.side"
    )
    return tiled, sides.filter("side = 0 or not own")


def linked_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, own: bool):
    """Index pairs of linked rows, in chunks; with `own`, pairs i < j of the one tile."""
    x, y = _unit(a) @ axes, _unit(b) @ axes
    d = x.shape[1]

    def suffix(z):  # norm of what follows the first k dimensions
        tail = np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.concatenate([tail, np.zeros((len(z), 1))], axis=1))

    sx, sy = suffix(x), suffix(y)
    head = min(STEP, d)
    norm_a = np.sqrt((a * a).sum(axis=1))
    norm_b = np.sqrt((b * b).sum(axis=1))
    rows_at_once = max(1, 1_000_000 // max(1, len(y)))
    for r in range(0, len(x), rows_at_once):
        part = x[r : r + rows_at_once, :head] @ y[:, :head].T
        may = part + np.outer(sx[r : r + rows_at_once, head], sy[:, head]) >= threshold - SLACK
        if own:
            may &= np.arange(r, r + len(part))[:, None] < np.arange(len(y))[None, :]
        rows, cols = np.nonzero(may)
        sums = part[rows, cols]
        rows = rows + r
        for c in range(0, len(rows), PAIRS):
            i, j, s = rows[c : c + PAIRS], cols[c : c + PAIRS], sums[c : c + PAIRS]
            for k in range(head, d, STEP):
                if not len(i):
                    break
                s = s + (x[i, k : k + STEP] * y[j, k : k + STEP]).sum(axis=1)
                end = min(k + STEP, d)
                on = s + sx[i, end] * sy[j, end] >= threshold - SLACK
                i, j, s = i[on], j[on], s[on]
            cosine = (a[i] * b[j]).sum(axis=1) / (norm_a[i] * norm_b[j])
            linked = cosine >= threshold
            yield i[linked], j[linked]


def _compare(members: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """`id, links, peer`: links of a vector within a pair of tiles; forest links have a peer."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        ids = table.column("id").to_numpy()
        weight = table.column("weight").to_numpy()
        own = table.column("own")[0].as_py()
        vectors = pa.concat_arrays(table.column("vector").chunks)
        matrix = _matrix(vectors)
        scale = np.abs(matrix).max(axis=1, keepdims=True)
        matrix = matrix / np.exp2(np.floor(np.log2(scale)))  # exact, keeps the cosine
        left = np.flatnonzero(side == 0)
        right = left if own else np.flatnonzero(side == 1)
        links = np.zeros(len(ids), dtype=np.int64)
        group = np.arange(len(ids))
        forest = []
        for i, j in linked_pairs(
            matrix[left], matrix[right], axes[matrix.shape[1]], threshold, own
        ):
            i, j = left[i], right[j]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            while len(i):
                apart = group[i] != group[j]
                i, j = i[apart], j[apart]
                if len(i):
                    # one new tree link per row of the smallest label seen first
                    forest.append((i[0], j[0]))
                    group[group == group[j[0]]] = group[i[0]]
        found = np.flatnonzero(links)
        u = ids[[f[0] for f in forest]] if forest else ids[:0]
        v = ids[[f[1] for f in forest]] if forest else ids[:0]
        peer = pa.concat_arrays([pa.nulls(len(found), pa.int64()), pa.array(v, pa.int64())])
        return pa.table(
            {
                "id": pa.array(np.concatenate([ids[found], u]), pa.int64()),
                "links": pa.array(np.concatenate([links[found], np.zeros(len(u), np.int64)])),
                "peer": peer,
            }
        )

    return members.groupBy("pair").applyInArrow(run, "id long, links long, peer long")


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """`vec_id, n_links, component_id, kept` for every vector."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).alias("vector"),
    )
    usable = rows.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & comparable(F.col("vector"))
    )
    classes = kept(
        usable.distinct()
        .groupBy("label", "vector")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("length", F.size("vector"))
    )
    axes = rotations(classes)
    tiled, sides = _tiles(_leading(classes, axes), (2 - 2 * threshold) ** 0.5 + SLACK)
    members = tiled.join(sides, ["label", "length", "strip", "sub"]).select(
        "pair", "own", "side", "id", "weight", "vector"
    )
    found = kept(_compare(members, axes, threshold))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.filter("peer is not null").select("id", "peer"))
    decided = (
        classes.join(links, "id", "left")
        .join(labels, "id", "left")
        .select(
            "label",
            "vector",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    linked = usable.distinct().join(decided, ["label", "vector"]).select(
        "id", "n_links", "component_id"
    )
    alone = rows.filter(
        F.col("id").isNull() | F.col("label").isNull() | ~comparable(F.col("vector"))
    ).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone.distinct()).select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
