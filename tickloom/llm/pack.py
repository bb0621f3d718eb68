"""Packing documents into sequences of fixed capacity by sum of squares.

Documents become token ids plus an end id. One longer than the capacity is cut into
full pieces behind a shorter first one. Pieces are dealt into groups of bounded
size; in each group they are placed by decreasing length. Among the open bins that
have room, a piece goes where the sum of squared counts of open bins per residual
gap becomes smallest; a tie goes to the tightest fit, and a bin is opened only when
none has room. A group leaves a few open bins, so waste falls as groups grow.

Memory of a task: one Arrow batch of texts, a bounded cache of words, one group.

Defined results: null text is empty and gives the end id alone. Repeated rows and
null ids are packed like any other row. Equal lengths are placed by id, then piece.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import grams
from tickloom.llm.common import worker_state

CAPACITY = 1024
GROUP_ROWS = 40_000  # documents of a packing group, on average
GROUPS = 1 << 38
CACHED_WORDS = 800_000  # of some 40 bytes
RUN_BYTES = 1_000_000  # of text encoded at once, while the words are new at some 300 bytes a byte
PIECE = "group long, doc_id long, piece int, start long, length long, ids_crc32 long"


# A text may be cut before a space that no white space follows. These bytes may start one.
_MAYBE_SPACE = np.zeros(256, dtype=bool)
_MAYBE_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """Ids of texts, each distinct word encoded once.

    Byte-level pre-tokenisation always ends a token before a space that is followed
    by something else than white space, so a text may be cut there and the ids of
    the parts joined. Parts repeat; a bounded cache, emptied when full, keeps theirs.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # bytes of an id
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self._empty()

    def _empty(self) -> None:
        """The cache: sorted hashes of words, and where each word's ids lie."""
        self.hashes = np.zeros(0, np.uint64)
        self.begin = self.size = np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, "<u4"), 0

    def _store(self, hashes: np.ndarray, ids: list[bytes]) -> None:
        new = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        if self.used + len(new) > len(self.flat):
            room = np.zeros(2 * (self.used + len(new)), "<u4")
            room[: self.used] = self.flat[: self.used]
            self.flat = room
        self.flat[self.used : self.used + len(new)] = new
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begin = np.insert(self.begin, at, self.used + np.cumsum(sizes) - sizes)
        self.size = np.insert(self.size, at, sizes)
        self.used += len(new)

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return at, (self.hashes[at] == hashes if len(self.hashes) else at < 0)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; those that start with a space are encoded as one text and cut."""
        joined = [w for w in words if w[:1] == b" "]
        ids = self._encode([b"".join(joined).decode()])[0]
        reach = np.cumsum(self.width[ids])
        ends = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
        cuts = np.searchsorted(reach, ends)
        if len(joined) and not (len(reach) == cuts[-1] + 1 and np.array_equal(reach[cuts], ends)):
            # an added token, whose name is not its bytes: one by one
            return [ids.tobytes() for ids in self._encode([w.decode() for w in words])]
        whole, begin, out = ids.tobytes(), 0, {}
        for word, end in zip(joined, (4 * (cuts + 1)).tolist()):
            out[word] = whole[begin:end]
            begin = end
        others = [w for w in words if w[:1] != b" "]
        out |= zip(others, (x.tobytes() for x in self._encode([w.decode() for w in others])))
        return [out[w] for w in words]

    def ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of texts, and where each text's ids begin and end."""
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(raw), dtype=bool)
        cut[:-1] = (raw[:-1] == 0x20) & ~_MAYBE_SPACE[raw[1:]]
        begins = offsets[:-1][np.diff(offsets) > 0]
        ends = offsets[1:][np.diff(offsets) > 0]
        cut[ends - 1] = False
        cut[begins] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(raw))
        hashes = grams.Rolling(grams.byte_values(raw)).spans(start, end)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        _, known = self._known(distinct)
        if len(self.hashes) + len(distinct) - known.sum() > CACHED_WORDS:
            self._empty()
            known[:] = False
        if not known.all():
            at = first[~known]
            whole = raw.tobytes()
            words = [whole[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]
            self._store(distinct[~known], self._encode_words(words))
        at, _ = self._known(distinct)
        before, sizes, flat = self.begin[at], self.size[at], self.flat
        counts = sizes[which]
        ids = flat[np.repeat(before[which], counts) + grams.ranges(counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[np.searchsorted(start, offsets)]


def _encoder(spec: str) -> Encoder:
    state = worker_state()
    key = zlib.crc32(spec.encode())
    if getattr(state, "tokenizer_key", None) != key:
        state.tokenizer, state.tokenizer_key = Encoder(spec), key
    return state.tokenizer


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece: full ones, behind a shorter first one."""
    if tokens <= capacity:
        return [(0, tokens)]
    first = tokens % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, tokens, capacity)]


def token_pieces(
    docs: DataFrame,
    spec: str,
    group: Column,
    end_id: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: `group, doc_id, piece, start, length, ids_crc32`, and `ids` if asked for.

    `spec` is the content of a tokenizer file, a few megabytes at most; `group` (a
    number) is taken over from the document.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    end = np.array([end_id], dtype="<u4").tobytes()
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["group", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    width = len(names) - (not with_ids)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            done = 0
            for docs, raw, offsets in grams.slices(batch, size=RUN_BYTES):
                rows = []
                groups = batch.column(2).slice(done, len(docs)).to_pylist()
                done += len(docs)
                all_ids, at = encoder.ids(raw, offsets)
                bounds = zip(groups, docs.to_pylist(), at[:-1].tolist(), at[1:].tolist())
                for near, doc, a, b in bounds:
                    ids = all_ids[a:b].tobytes() + end
                    for k, (start, length) in enumerate(cut(b - a + 1, capacity)):
                        part = ids[4 * start : 4 * (start + length)]
                        row = (near, doc, k, start, length, zlib.crc32(part), part)
                        rows.append(row[:width])
                arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names[:width])

    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        group.cast("long").alias("group"),
    )
    return slim.mapInArrow(pieces, PIECE + (", ids binary" if with_ids else ""))


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items come in decreasing length."""
    open_bins = np.zeros(capacity + 1, dtype=np.int64)  # per gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        here = open_bins[size:capacity]  # gaps that have room
        if here.any():
            # half the change of the sum of squares, by the gap that is left
            change = (open_bins[: capacity - size] - here + 1).astype(float)
            change[0] = 0.5 - here[0]  # a full bin is no longer open
            change[here == 0] = np.inf
            left = int(change.argmin())
            gap = left + size
            open_bins[gap] -= 1
            chosen = by_gap[gap].pop()
        else:
            chosen, made, gap = made, made + 1, capacity
            left = capacity - size
        bins[i], offsets[i] = chosen, capacity - gap
        if left:
            open_bins[left] += 1
            by_gap[left].append(chosen)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`; needs `group`, `doc_id`, `piece`, `length`.

    A group makes fewer than 2**24 sequences; its number is the upper part of their ids.
    """
    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name != "group"
    )

    def packed(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        length = table.column("length").to_numpy()
        doc = table.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        order = np.lexsort((table.column("piece").to_numpy(), doc, -length))
        bins, offsets = place(length[order], capacity)
        table = table.drop_columns("group").take(pa.array(order))
        table = table.append_column("sequence_id", pa.array((group << 24) + bins))
        return table.append_column("offset", pa.array(offsets))

    return pieces.groupBy("group").applyInArrow(packed, fields + ", sequence_id long, offset long")


def neighbours(docs: DataFrame, group_rows: int = GROUP_ROWS) -> Column:
    """A group for rows that stand together in the files `docs` is read from.

    Groups, and so sequences, are numbered as the part files are; files that are not
    numbered get a hash.
    """
    run = F.floor(F.col("_metadata.row_index") / group_rows)
    part = F.regexp_extract("_metadata.file_path", r"/part-(\d{1,7})[^/]*$", 1)
    place = part.try_cast("long") * F.lit(2**14) + F.pmod(run, F.lit(2**14))
    other = F.pmod(F.xxhash64("_metadata.file_path", run), F.lit(GROUPS))
    return F.when(part == "", other).otherwise(place)


def pack_documents(
    docs: DataFrame,
    spec: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    group: Column | None = None,
) -> DataFrame:
    """Every piece of every document with its place, and its ids if asked for.

    Documents of one `group` (a number below `GROUPS`, some `group_rows` documents)
    share sequences; by default a hash of id and length deals them out.
    """
    if group is None:
        groups = min(GROUPS, max(1, -(-docs.count() // group_rows)))
        # rows that repeat an id or have none spread, too
        group = F.pmod(F.xxhash64(id_col, F.length(text_col)), F.lit(groups))
    pieces = token_pieces(docs, spec, group, end_id, capacity, id_col, text_col, with_ids)
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """`sequence_id, length, ids binary, doc_ids array`: the sequences themselves."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), parts.alias("parts"))
        .select(
            "sequence_id",
            "length",
            F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"),
            F.col("parts.doc_id").alias("doc_ids"),
        )
    )
