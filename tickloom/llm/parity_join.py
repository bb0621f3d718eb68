"""N-gram Jaccard join by parity sketches.

A text is the set of its word shingles. Two parity sketches are made of it. In the
long one, each shingle flips one bit, so the Hamming distance of two sketches never
exceeds the symmetric difference of the sets. In the short one, shingles are dealt
into classes and a class is the XOR of its shingles' hashes. Sets that are similar
enough differ in at most d shingles, so with more than d classes some are equal:
documents of a size band meet on equal classes (pigeonhole), pass if the Hamming
distance allows it, and are verified on the sets themselves.

Equal sets are one class from the start. Within a group of equal words only a
spanning forest of the pairs that may link goes on to verification. A group with a
refuted pair tries again with the next nearest pairs of what is not connected yet, as
does a group with a row that had more of them than it named, until none is left. So no
link between components is lost, and a group emits no pairs within what is connected.

Documents that share one class mostly share many, so a large group would come back
under each of its classes. Therefore only groups of at most `SMALL` members are sent as
they are. Of larger ones, those under the first `FIRST` classes of a document are sent,
cut into blocks that have their first `HUB` members in common; what they link gives
components. The documents of large groups then meet once more: groups that lie in one
component are passed over. Where one component holds half of a group or more, the others
in the group are the rest that this component met. The rests that it met under all
classes of a band are one, and meet the whole component and themselves in blocks, once. A
group without such a component is sent as blocks that meet in pairs where they hold
different components. So the rows of a document do not grow with the number of classes
that a large group shares, and not with the group while it is connected.

Defined results: null text, or text without words, has an empty set and links with
nothing. A text with fewer words than a shingle is one shingle. Repeated rows link
with themselves only; of rows that share an id but not their set, the least text stands
for the id and the others link as equal sets only. A null id is left out of links and is its own
component. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import grams
from tickloom.llm.common import BROADCAST_IDS, kept, only, shuffle_partitions
from tickloom.llm.components import components

BLOCK = 2_000
SMALL = 250
FIRST = 12
HUB = 50
HOT_ROWS = 64  # in which each part of the classes names the documents of its large groups
PART_SHINGLES = 5_000_000  # of the documents, for each part of the classes
PART_MEMBERS = 25_000  # of groups, for each partition of what comes of them
SIZES = "doc_id long, n long, s1 long, s2 long"
UNPACKED = "gid long, band int, doc_id long"
GROUPS = "band int, top long, members binary"
SKETCH = "doc_id long, n long, band int, words binary"
FLIP_BITS = 16  # bits of the long sketch per shingle that may differ


@dataclass(frozen=True)
class Similarity:
    """Link when parts * intersection >= needed * union."""

    words: int = 3
    needed: int = 90
    parts: int = 100

    def bands(self) -> np.ndarray:
        """First size of each band; similar sets lie in one band or in neighbours."""
        out, t = [], 0
        while not out or out[-1] < 2**36:
            out.append(-(-(self.parts**t) // self.needed**t))
            t += 1
        return np.array(out)

    def difference(self, total):
        """Largest symmetric difference of two linked sets with `total` members in all."""
        return total * (self.parts - self.needed) // (self.parts + self.needed)

    def classes(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each band, with the one above: sketch words, and how many are equal at least.

        Pairs of one band meet there, pairs of neighbours in the lower one, so the two
        sizes add up to less than the first sizes of the next two bands. Some more
        words than needed keep documents from depending on their empty classes.
        """
        after = np.append(first[1:], first[-1:].repeat(2))
        most = self.difference(after[:-1] + after[1:] - 2)[: len(first)]
        spare = 2 + most * 15 // 100
        return most + spare, spare


def shingles(raw, offsets, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and their number per text."""
    words = grams.Words(grams.lower_ascii(raw), offsets)
    counts = words.counts
    rolling = grams.Rolling(words.hash)
    starts = grams.window_starts(words.offsets, size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    hashes = np.concatenate(
        [
            rolling.spans(starts, starts + size),
            rolling.spans(words.offsets[short], words.offsets[short + 1]),
        ]
    )
    texts = np.arange(len(counts))
    owner = np.concatenate([np.repeat(texts, np.maximum(counts - size + 1, 0)), short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
    return hashes, np.bincount(owner, minlength=len(counts))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(counts)
    return (total[ends] - total[ends - counts]).view(np.int64)


def _classes(hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The short sketches of all texts, one after the other; `classes` words each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(classes) - classes
    word = (hashes % classes.astype(np.uint64)[owner]).astype(np.int64) + before[owner]
    out = np.zeros(int(classes.sum()), dtype=np.uint64)
    np.bitwise_xor.at(out, word, grams.mix(hashes.copy()))
    return out


def _flips(hashes: np.ndarray, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The long sketches of all texts, one after the other; `words` words of 64 bits each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(words) - words
    bit = grams.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) % (64 * words.astype(np.uint64))[owner]
    out = np.zeros(int(words.sum()), dtype=np.uint64)
    word = (bit >> np.uint64(6)).astype(np.int64) + before[owner]
    np.bitwise_xor.at(out, word, np.uint64(1) << (bit & np.uint64(63)))
    return out


def sizes(docs: DataFrame, rule: Similarity, id_col: str, text_col: str) -> DataFrame:
    """`doc_id, n, s1, s2`: size of each set, and two sums that equal sets share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw, offsets in grams.slices(batch):
                hashes, n = shingles(raw, offsets, rule.words)
                one = _sums(grams.mix(hashes.copy()), n)
                two = _sums(grams.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), n)
                arrays = [ids, pa.array(n, pa.int64()), pa.array(one), pa.array(two)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "s1", "s2"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SIZES)


def _banded(batch: pa.RecordBatch, rule: Similarity):
    """Rows, ids, sizes, bands and shingles of texts: once for the own band, once for that below."""
    first = rule.bands()
    done = 0
    for ids, raw, offsets in grams.slices(batch):
        hashes, n = shingles(raw, offsets, rule.words)
        ends = np.cumsum(n)
        band = np.searchsorted(first, n, side="right") - 1
        doc = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        for step in (0, 1):
            use = np.flatnonzero((n > 0) & (band >= step))
            mine = hashes[np.repeat((ends - n)[use], n[use]) + grams.ranges(n[use])]
            yield done + use, doc[use], n[use], band[use] - step, mine
        done += len(n)


def sketches(docs: DataFrame, rule: Similarity) -> DataFrame:
    """`doc_id, n, band, words`: long sketches of every document (`doc_id`, `text`)."""
    classes, spare = rule.classes(rule.bands())
    length = FLIP_BITS * (classes - spare) // 64 + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, doc, n, band, hashes in _banded(batch, rule):
                k = length[band]
                words, ends = _flips(hashes, n, k), np.cumsum(k)
                cut = [words[e - c : e].tobytes() for c, e in zip(k, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc),
                        pa.array(n, pa.int64()),
                        pa.array(band, pa.int32()),
                        pa.array(cut, pa.binary()),
                    ],
                    ["doc_id", "n", "band", "words"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SKETCH)


KEY_BYTES = 5  # 31 bits of a hash, the flag and the band
BAND = np.uint64(511)  # the band, and whether the class is one of the first
BAND_ONLY, FIRST_ONLY = np.uint64(255), np.uint64(256)


def _packed(keys: np.ndarray, docs: np.ndarray, tops: np.ndarray) -> tuple[bytes, ...]:
    """Short keys, the distinct documents, their components, and each key's document by place."""
    short = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    ids, first, place = np.unique(docs, return_index=True, return_inverse=True)
    return short.tobytes(), ids.tobytes(), tops[first].tobytes(), place.astype(_place_kind(len(ids))).tobytes()


def _place_kind(ids: int):
    return np.uint16 if ids <= 2**16 else np.uint32


def _unpacked(keys: bytes, ids: bytes, tops: bytes, places: bytes) -> tuple[np.ndarray, ...]:
    short = np.frombuffer(keys, np.uint8).reshape(-1, KEY_BYTES)
    wide = np.zeros((len(short), 8), dtype=np.uint8)
    wide[:, :KEY_BYTES] = short
    ids, tops = np.frombuffer(ids, np.int64), np.frombuffer(tops, np.int64)
    place = np.frombuffer(places, _place_kind(len(ids)))
    return wide.view(np.uint64).ravel(), ids[place], tops[place]


def _blocks(members: np.ndarray, tops: np.ndarray) -> Iterator[np.ndarray]:
    """Groups that hold every pair of different components (`tops`) of a large group."""
    order = np.lexsort((members, tops))
    members, tops = members[order], tops[order]
    for i in range(0, len(members), BLOCK):
        for j in range(i, len(members), BLOCK):
            if tops[i] != tops[min(j + BLOCK, len(tops)) - 1]:  # components are in order
                yield np.union1d(members[i : i + BLOCK], members[j : j + BLOCK])


def _with_hub(members: np.ndarray) -> Iterator[np.ndarray]:
    """A large group as blocks with common members."""
    for i in range(0, len(members), BLOCK):
        yield np.union1d(members[i : i + BLOCK], members[:HUB])


def candidate_groups(docs: DataFrame, rule: Similarity, parts: int, again: bool) -> DataFrame:
    """`band, top, members`: groups of documents (`doc_id`, `text`) that share a class.

    Large groups are sent as blocks of their first classes, and rows with a negative band
    name their members. With `again` (and `top`, the components so far) only large groups
    of several components are sent: as blocks, or, with `top`, the rest that a component met.
    """
    classes, equal = rule.classes(rule.bands())

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            top = batch.column(2).to_numpy()  # of no use at first
            for rows, ids, n, band, hashes in _banded(batch, rule):
                k = classes[band]
                words = _classes(hashes, n, k)
                owner = np.repeat(np.arange(len(ids)), k)
                zero = words == 0
                # If all equal classes are empty, both sides have at least so many.
                many = np.bincount(owner[zero], minlength=len(ids)) >= equal[band]
                place = grams.ranges(k)
                use = ~zero | many[owner]
                words, owner, place = words[use], owner[use], place[use].astype(np.uint64)
                first = (place < FIRST).astype(np.uint64) << np.uint64(8)
                place *= np.uint64(2654435761)
                mixed = grams.mix(words + grams.mix(place + band.astype(np.uint64)[owner]))
                key = (mixed & ~BAND) | first | band.astype(np.uint64)[owner]
                part = ((key >> np.uint64(8 * KEY_BYTES)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                key, part = key[order], part[order]
                doc, tops = ids[owner[order]], top[rows[owner[order]]]
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                ends = np.append(cuts[1:], len(part))[: len(cuts)]
                packed = [_packed(key[a:b], doc[a:b], tops[a:b]) for a, b in zip(cuts, ends)]
                columns = [pa.array([x[i] for x in packed], pa.binary()) for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[cuts], pa.int32()), *columns],
                    ["part", "keys", "ids", "tops", "places"],
                )

    def meet(table: pa.Table) -> pa.Table:
        rows = zip(*(table.column(c).to_pylist() for c in ("keys", "ids", "tops", "places")))
        key, doc, top = (np.concatenate(x) for x in zip(*(_unpacked(*row) for row in rows)))
        order = np.lexsort((doc, key))
        key, doc, top = key[order], doc[order], top[order]
        new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))  # not a repeated row
        key, doc, top = key[new], doc[new], top[new]
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        ends = np.append(cuts[1:], len(key))
        found, hot, rests = set(), [], {}
        for a, b in zip(cuts[ends - cuts > 1], ends[ends - cuts > 1]):
            band, first = int(key[a] & BAND_ONLY), bool(key[a] & FIRST_ONLY)
            if b - a <= SMALL:
                if not again:
                    found.add((band, None, doc[a:b].tobytes()))
            elif again:
                tops, held = np.unique(top[a:b], return_counts=True)
                most = tops[held.argmax()]
                if 2 * held.max() < b - a:
                    found.update((band, None, x.tobytes()) for x in _blocks(doc[a:b], top[a:b]))
                elif len(tops) > 1:
                    rests.setdefault((band, int(most)), []).append(doc[a:b][top[a:b] != most])
            else:
                hot.append(doc[a:b])
                if first:
                    found.update((band, None, x.tobytes()) for x in _with_hub(doc[a:b]))
        if hot:
            ids = np.unique(np.concatenate(hot))
            row = grams.mix(ids.view(np.uint64)) % np.uint64(HOT_ROWS)
            found.update((-1 - i, None, ids[row == i].tobytes()) for i in range(HOT_ROWS))
        found.update((*at, np.unique(np.concatenate(x)).tobytes()) for at, x in rests.items())
        out = _groups(found)
        del key, doc, top, order, new, cuts, ends, found, rests
        grams.settle()
        return out

    if not again:
        docs = docs.withColumn("top", F.lit(0).cast("long"))
    packed = docs.select("doc_id", "text", "top").mapInArrow(
        keys, "part int, keys binary, ids binary, tops binary, places binary"
    )
    return packed.groupBy("part").applyInArrow(meet, GROUPS).distinct()


def _groups(found) -> pa.Table:
    band, top, members = zip(*found) if found else ((), (), ())
    columns = [pa.array(band, pa.int32()), pa.array(top, pa.int64()), pa.array(members, pa.binary())]
    return pa.table(columns, ["band", "top", "members"])


def _met(found: DataFrame, tops: DataFrame) -> DataFrame:
    """`band, members`: the groups in `found`, and blocks of components with the rests they met.

    All that a component met in a band is cut into blocks. Each meets every block of the
    component, and every other one of the rest.
    """

    def rest(table: pa.Table) -> pa.Table:
        ids = np.unique(_ids(table.column("members")))
        band, top = table.column("band")[0].as_py(), table.column("top")[0].as_py()
        blocks = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
        out = [(band, top, x.tobytes()) for x in blocks]
        out += [(band, None, np.union1d(x, y).tobytes()) for x, y in combinations(blocks, 2)]
        return _groups(out)

    def pack(table: pa.Table) -> pa.Table:
        held = table.column("doc_id").to_numpy().tobytes()
        return pa.table({"top": table.column("top")[:1], "held": pa.array([held], pa.binary())})

    rests = kept(found.filter("top is not null").groupBy("band", "top").applyInArrow(rest, GROUPS))
    blocks = rests.filter("top is not null")
    sides = only(tops, kept(blocks.select("top").distinct()))
    number = sides.groupBy("top").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("block")
    sides = sides.join(F.broadcast(number), "top").select("top", "doc_id", block)
    sides = sides.groupBy("top", "block").applyInArrow(pack, "top long, held binary")
    both = blocks.join(sides, "top").select("band", F.concat("held", "members").alias("members"))
    whole = found.union(rests).filter("top is null").select("band", "members")
    return whole.union(both)


def _pairs(
    words, n, tops, yes, no, tries: int, rule: Similarity
) -> tuple[list[tuple[int, int]], bool]:
    """Pairs of rows that may link and would join what `tops` and `yes` have not joined yet.

    With one try they are a forest; with more, a row names so many of its nearest.
    Also whether some row had more than it named.
    """
    group = np.unique(tops, return_inverse=True)[1]
    for i, j in yes:
        group[group == group[j]] = group[i]
    refused: dict[int, list[int]] = {}
    for i, j in no:
        refused.setdefault(min(i, j), []).append(max(i, j))
    out, more = [], False
    for i in range(len(n) - 1):
        rest = np.flatnonzero(group[i + 1 :] != group[i]) + i + 1
        if not len(rest):
            continue
        far = np.bitwise_count(words[rest] ^ words[i]).sum(axis=1, dtype=np.int64)
        may = far <= rule.difference(n[rest] + n[i])
        if i in refused:
            may &= ~np.isin(rest, refused[i])
        rest, far = rest[may], far[may]
        if tries > 1:
            more |= len(rest) > tries
            out.extend((i, int(j)) for j in rest[np.argsort(far, kind="stable")[:tries]])
            continue
        while len(rest):
            j = rest[far.argmin()]
            out.append((i, int(j)))
            group[group == group[j]] = group[i]
            apart = group[rest] != group[i]
            rest, far = rest[apart], far[apart]
    return out, more


def _in_parts(df: DataFrame, parts: int) -> DataFrame:
    """`df` in at most so many partitions, where a shuffle would make more."""
    return df.coalesce(parts) if parts < shuffle_partitions(df.sparkSession) else df


def pairs_to_verify(
    groups: DataFrame, rows: DataFrame, answers, tries: int, rule: Similarity, parts: int
) -> DataFrame:
    """`gid, a, b, more` with a < b: what each group wants to have verified next.

    `answers` (`gid, a, b, linked`) are what it has been told. `more` says that the group
    has further pairs to name even if all of these link.
    """
    unpacked = groups.mapInArrow(_unpack, UNPACKED)
    members = _in_parts(unpacked.join(rows, ["doc_id", "band"]), parts)
    if answers is None:
        none = F.lit(None).cast("array<bigint>")
        members = members.withColumns({"yes": none, "no": none})
    else:
        results = answers.groupBy("gid", F.col("a").alias("doc_id")).agg(
            F.collect_set(F.when(F.col("linked"), F.col("b"))).alias("yes"),
            F.collect_set(F.when(~F.col("linked"), F.col("b"))).alias("no"),
        )
        members = _in_parts(members.join(_in_parts(results, parts), ["gid", "doc_id"], "left"), parts)

    def choose(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        doc = table.column("doc_id").to_pylist()
        at = {d: i for i, d in enumerate(doc)}
        words = np.stack([np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()])
        known = {
            side: [
                (i, at[partner])
                for i, partners in enumerate(table.column(side).to_pylist())
                for partner in partners or ()
                if partner in at
            ]
            for side in ("yes", "no")
        }
        sizes = table.column("n").to_numpy()
        tops = table.column("top").to_numpy()
        chosen, more = _pairs(words, sizes, tops, known["yes"], known["no"], tries, rule)
        pairs = [sorted((doc[i], doc[j])) for i, j in chosen]
        gid = table.column("gid")[0].as_py()
        return pa.table(
            {
                "gid": pa.array([gid] * len(pairs), pa.int64()),
                "a": pa.array([p[0] for p in pairs], pa.int64()),
                "b": pa.array([p[1] for p in pairs], pa.int64()),
                "more": pa.array([more] * len(pairs), pa.bool_()),
            }
        )

    columns = members.select("gid", "doc_id", "n", "top", "words", "yes", "no")
    wanted = columns.groupBy("gid").applyInArrow(choose, "gid long, a long, b long, more boolean")
    return _in_parts(wanted, parts)


def _ids(members: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.frombuffer(m, np.int64) for m in members.to_pylist()])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members = [np.frombuffer(m, np.int64) for m in batch.column("members").to_pylist()]
        sizes = [len(m) for m in members]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(batch.column("gid").to_numpy(), sizes), pa.int64()),
                pa.array(np.repeat(batch.column("band").to_numpy(), sizes), pa.int32()),
                pa.array(np.concatenate(members) if members else [], pa.int64()),
            ],
            ["gid", "band", "doc_id"],
        )


def sets_of(docs: DataFrame, ids: DataFrame, rule: Similarity) -> DataFrame:
    """`doc_id, hashes`: the shingle sets of the documents in `ids`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, raw, offsets in grams.slices(batch):
                hashes, n = shingles(raw, offsets, rule.words)
                ends = np.cumsum(n)
                sets = [hashes[e - c : e].tobytes() for c, e in zip(n, ends)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(sets, pa.binary())],
                    ["doc_id", "hashes"],
                )

    found = only(docs, ids).mapInArrow(run, "doc_id long, hashes binary")
    return found.dropDuplicates(["doc_id"])


def verify(pairs: DataFrame, sets: DataFrame, rule: Similarity, parts: int) -> DataFrame:
    """`a, b, linked` for every pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            x_all, x_at = grams.text_bytes(batch.column(2))
            y_all, y_at = grams.text_bytes(batch.column(3))
            for i in range(batch.num_rows):
                x = x_all[x_at[i] : x_at[i + 1]].view(np.uint64)
                y = y_all[y_at[i] : y_at[i + 1]].view(np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(rule.parts * both >= rule.needed * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                ["a", "b", "linked"],
            )
            grams.settle()

    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y"))
    joined = _in_parts(_in_parts(pairs.join(left, "a"), parts).join(right, "b"), parts)
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def connect(
    groups: DataFrame,
    rows: DataFrame,
    texts: DataFrame,
    checked: DataFrame | None,
    rule: Similarity,
    parts: int,
    once: int | None = None,
) -> DataFrame | None:
    """`checked` (`a, b, linked`) and what verifying these groups adds, until each is settled.

    Groups of more than `once` members name pairs in the first round only.
    """

    def stored(df: DataFrame) -> DataFrame:
        return kept(_in_parts(df, parts))

    left, answers, tries = groups, None, 1
    while not left.isEmpty():
        wanted = kept(pairs_to_verify(left, rows, answers, tries, rule, parts))
        pairs = _in_parts(wanted.select("a", "b").distinct(), parts)
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        if not pairs.isEmpty():
            ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
            sets = _in_parts(sets_of(texts, ids, rule), parts)
            new = kept(verify(pairs, sets, rule, parts))
            checked = new if checked is None else stored(checked.union(new))
        if wanted.isEmpty():
            break
        told = wanted.join(checked, ["a", "b"]).select("gid", "a", "b", "linked", "more")
        told = stored(told)
        answers = told.drop("more") if answers is None else answers.union(told.drop("more"))
        # a group that named all its pairs is connected if they link; the others try again
        left = left.join(told.filter("more or not linked").select("gid"), "gid", "left_semi")
        left = stored(left if once is None else left.filter(F.length("members") <= 8 * once))
        tries *= 8
    return checked


def _united(rows: DataFrame) -> DataFrame:
    """`doc_id`: the distinct members of rows, those of a band by one task."""

    def unite(table: pa.Table) -> pa.Table:
        return pa.table({"doc_id": pa.array(np.unique(_ids(table.column("members"))))})

    return rows.groupBy("band").applyInArrow(unite, "doc_id long")


def _checked(
    groups: DataFrame,
    texts: DataFrame,
    checked: DataFrame | None,
    rule: Similarity,
    tops: DataFrame | None = None,
) -> DataFrame | None:
    """`checked` and the verified pairs of these groups; `tops` are the components so far.

    Without `tops`, groups of more than `SMALL` members are to come back with them.
    """
    groups = kept(groups.withColumn("gid", F.xxhash64("band", "members")))
    if groups.isEmpty():
        return checked
    size = groups.agg(F.sum(F.length("members") / 8)).first()[0]
    parts = max(1, -(-int(size) // PART_MEMBERS))
    groups = _in_parts(groups, parts)
    ids = groups.mapInArrow(_unpack, UNPACKED).select("doc_id").distinct()
    members = kept(_in_parts(ids, parts))
    rows = sketches(only(texts, members), rule).dropDuplicates(["doc_id", "band"])
    if tops is None:
        rows = rows.withColumn("top", F.col("doc_id"))
    else:
        rows = _in_parts(rows, parts).join(tops, "doc_id")
    once = SMALL if tops is None else None
    return connect(groups, kept(_in_parts(rows, parts)), texts, checked, rule, parts, once)


def jaccard_classes(
    docs: DataFrame,
    rule: Similarity = Similarity(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of `docs`."""
    measured = kept(sizes(docs, rule, id_col, text_col))
    filled = measured.filter("n > 0 and doc_id is not null")
    equal = filled.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    copies = filled.join(equal, ["n", "s1", "s2"]).filter("doc_id <> rep").select("doc_id")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.filter("doc_id is not null")
    sets = F.struct("n", "s1", "s2")
    several = filled.groupBy("doc_id").agg(F.min(sets).alias("a"), F.max(sets).alias("b"))
    several = kept(several.filter("a <> b").select("doc_id"))
    if not several.isEmpty():
        least = only(texts, several).groupBy("doc_id").agg(F.min("text").alias("text"))
        texts = only(texts, several, "left_anti").unionByName(least)
    single = only(texts, kept(copies.distinct()), "left_anti")
    volume = filled.agg(F.sum("n")).first()[0] or 0
    parts = max(shuffle_partitions(docs.sparkSession), volume // PART_SHINGLES)
    alone = single.withColumn("top", F.lit(None).cast("long"))
    named = kept(candidate_groups(alone, rule, parts, False))
    hot = kept(_united(named.filter("band < 0")))
    checked = _checked(named.filter("band >= 0").select("band", "members"), texts, None, rule)
    if not hot.isEmpty():
        tops = hot.withColumn("top", F.col("doc_id"))
        if checked is not None:
            found = components(checked.filter("linked").select("a", "b")).toDF("doc_id", "found")
            tops = tops.join(found, "doc_id", "left").select("doc_id", F.coalesce("found", "top").alias("top"))
        tops = kept(tops)
        few = tops.count() <= BROADCAST_IDS
        again = texts.join(F.broadcast(tops) if few else tops, "doc_id")
        found = kept(candidate_groups(again, rule, parts, True))
        checked = _checked(_met(found, tops), texts, checked, rule, tops)
    keys = ["n", "s1", "s2"]
    out = measured.join(equal, keys, "left")
    if checked is None:
        out = out.withColumn("component", F.lit(None).cast("long"))
    else:
        links = checked.filter("linked").select("a", "b")
        out = out.join(components(links).toDF("rep", "component"), "rep", "left")
    top = F.coalesce("component", "rep", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), top).alias("component_id"),
    )


def drop_similar(
    docs: DataFrame,
    rule: Similarity = Similarity(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its component, with their columns."""
    classes = jaccard_classes(docs, rule, id_col, text_col)
    gone = classes.filter("doc_id <> component_id").select(F.col("doc_id").alias(id_col))
    return only(docs, kept(gone.distinct()), "left_anti")
