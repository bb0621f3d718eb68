"""Texts in buckets, and 64-bit keys that buckets exchange to find what recurs.

Documents are dealt into buckets of bounded volume by a hash of their id. A bucket
sends each of its keys once, packed into one binary per part of the key space; the
part answers each bucket with what it needs to know. So a key that a third of all
documents share is one entry per bucket, whatever its number of occurrences.

The shuffled texts are read by several steps of a query; equal exchanges of one
plan are computed once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import shuffle_partitions

BUCKET_BYTES = 12_000_000
LAST_ID = 2**63 - 1  # stands for a null id


def bucketed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """`doc_id, text, bucket`, shuffled by bucket, and the number of buckets."""
    volume = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(shuffle_partitions(docs.sparkSession), -(-volume // BUCKET_BYTES))
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int").alias("bucket"),
    )
    return texts.repartition(buckets, "bucket"), buckets


ONE = np.uint64(1)
PACKED = "part int, bucket int, keys binary, docs binary"


def pack_keys(bucket: int, parts: int, keys: np.ndarray, docs: np.ndarray) -> pa.Table:
    """Distinct keys of a bucket with their smallest document, one row per part.

    The lowest bit of a packed key says whether the bucket has it in several documents.
    """
    keys = keys & ~ONE
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    if len(keys):
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        last = np.append(first[1:], len(keys)) - 1
        several = (docs[last] != docs[first]).astype(np.uint64)
        keys, docs = keys[first] | several, docs[first]
    part = ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    keys, docs, part = keys[order], docs[order], part[order]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(cuts[1:], len(part))[: len(cuts)]
    return pa.table(
        {
            "part": pa.array(part[cuts], pa.int32()),
            "bucket": pa.array(np.full(len(cuts), bucket), pa.int32()),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            "docs": pa.array([docs[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        }
    )


ANSWERS = "bucket int, keys binary, docs binary"


def smallest_documents(packed: DataFrame) -> DataFrame:
    """Answers: keys of a bucket that recur, lowest bit cleared, with their smallest document."""

    def answer(table: pa.Table) -> pa.Table:
        counts = [len(k) // 8 for k in table.column("keys").to_pylist()]
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
        docs = np.frombuffer(b"".join(table.column("docs").to_pylist()), np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        several, keys = (keys & ONE) == 1, keys & ~ONE
        order = np.lexsort((docs, keys))
        keys, docs, row, several = keys[order], docs[order], row[order], several[order]
        first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
        least = docs[first][np.cumsum(first) - 1] if len(keys) else docs
        tell = ~first | several
        return _answers(table, row[tell], keys[tell], least[tell])

    return packed.groupBy("part").applyInArrow(answer, ANSWERS)


def _answers(table: pa.Table, row: np.ndarray, keys: np.ndarray, docs: np.ndarray) -> pa.Table:
    buckets = table.column("bucket").to_numpy()
    order = np.argsort(row, kind="stable")
    row, keys, docs = row[order], keys[order], docs[order]
    cuts = np.flatnonzero(np.diff(row, prepend=-1))
    ends = np.append(cuts[1:], len(row))[: len(cuts)]
    return pa.table(
        {
            "bucket": pa.array(buckets[row[cuts]], pa.int32()),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            "docs": pa.array([docs[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        }
    )


HOLDERS = "bucket int, keys binary, docs binary, holders binary"


def first_holders(packed: DataFrame) -> DataFrame:
    """For the bucket of a key's smallest document: keys that recur, that document, who has them.

    One entry per key and bucket that has it (`holders`, 32-bit numbers); the first
    bucket itself only if several of its documents have the key. A key that only
    rows without an id have is nobody's.
    """

    def answer(table: pa.Table) -> pa.Table:
        counts = [len(k) // 8 for k in table.column("keys").to_pylist()]
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
        docs = np.frombuffer(b"".join(table.column("docs").to_pylist()), np.int64)
        holder = np.repeat(table.column("bucket").to_numpy().astype(np.int32), counts)
        several, keys = (keys & ONE) == 1, keys & ~ONE
        order = np.lexsort((docs, keys))
        keys, docs, holder, several = keys[order], docs[order], holder[order], several[order]
        first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
        group = np.cumsum(first) - 1
        least, owner = docs[first][group], holder[first][group]
        tell = (~first | several) & (least != LAST_ID)
        order = np.flatnonzero(tell)[np.argsort(owner[tell], kind="stable")]
        owner, keys, least, holder = owner[order], keys[order], least[order], holder[order]
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        spans = list(zip(cuts, np.append(cuts[1:], len(owner))[: len(cuts)]))
        columns = [[x[a:b].tobytes() for a, b in spans] for x in (keys, least, holder)]
        return pa.table(
            [pa.array(owner[cuts], pa.int32()), *(pa.array(c, pa.binary()) for c in columns)],
            ["bucket", "keys", "docs", "holders"],
        )

    return packed.groupBy("part").applyInArrow(answer, HOLDERS)


LEVEL = np.uint64(63)  # low bits of a weighted key: how many documents, as a power of two


def pack_weighted(bucket: int, parts: int, keys: np.ndarray, docs: np.ndarray) -> pa.Table:
    """Distinct keys of a bucket, their number of documents (rounded up) in the low bits."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    if len(keys):
        new = np.append(True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1]))
        keys = keys[new]
        new = np.append(True, keys[1:] != keys[:-1])
        begins = np.flatnonzero(new)
        counts = np.diff(np.append(begins, len(keys)))
        keys = keys[new]
        level = np.ceil(np.log2(counts)).astype(np.uint64)
        keys = (keys & ~LEVEL) | level
    part = ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    keys, part = keys[order], part[order]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(cuts[1:], len(part))[: len(cuts)]
    return pa.table(
        {
            "part": pa.array(part[cuts], pa.int32()),
            "bucket": pa.array(np.full(len(cuts), bucket), pa.int32()),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        }
    )


def recurring(packed: DataFrame) -> DataFrame:
    """`bucket, keys`: keys of two documents or more, their number (as above) in the low bits."""

    def answer(table: pa.Table) -> pa.Table:
        counts = [len(k) // 8 for k in table.column("keys").to_pylist()]
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
        row = np.repeat(np.arange(len(counts)), counts)
        order = np.argsort(keys)
        keys, row = keys[order], row[order]
        plain = keys & ~LEVEL
        first = np.append(True, plain[1:] != plain[:-1]) if len(keys) else np.zeros(0, bool)
        group = np.cumsum(first) - 1
        many = np.bincount(group, weights=2.0 ** (keys & LEVEL).astype(float))
        found = many[group] >= 2
        level = np.ceil(np.log2(many[group][found])).astype(np.uint64)
        out = _answers(table, row[found], plain[found] | level, row[found])
        return out.select(["bucket", "keys"])

    return packed.groupBy("part").applyInArrow(answer, "bucket int, keys binary")


def answered(table: pa.Table) -> tuple[np.ndarray, np.ndarray | None]:
    """All keys, sorted, and documents of the answers a bucket got."""
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    order = np.argsort(keys)
    if "docs" not in table.column_names:
        return keys[order], None
    docs = np.frombuffer(b"".join(table.column("docs").to_pylist()), np.int64)
    return keys[order], docs[order]


def place_of(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key in the sorted `keys`, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def anchors(hashes: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For the window of `width` positions at each start, its least position (a minimizer).

    Equal windows choose equal offsets: the least hash, then the leftmost. Returns
    the chosen position of each start.
    """
    bits = np.uint64(30)  # a batch has fewer positions
    place = np.arange(len(hashes), dtype=np.uint64)
    least = (hashes >> bits << bits) | place
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    if span < width:
        rest = width - span
        least = np.minimum(least[: len(least) - rest], least[rest:])
    return (least[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of `n` positions lie in a window of `width` at one of the starts."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0
