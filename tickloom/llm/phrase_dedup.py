"""Substring dedup with repeated-phrase automata.

A word is removed when a window of 50 words covers it whose word sequence also
starts in a document with a smaller id.

1. Each window chooses one phrase of 12 words in it (a minimizer), so equal windows
   choose equal phrases. Windows whose phrase recurs are exchanged as hashes, once per
   bucket; what recurs is told to the bucket of the smallest document that has it.
2. That bucket confirms the passages: runs of such windows in that document. It sends
   their text to the buckets that have any of it.
3. Per bucket, the passages it got are compiled into an Aho-Corasick automaton, one
   shard of the automata: of each passage as many phrases as it takes for every
   window to contain one. All documents of the bucket are streamed through it.
4. Where a phrase occurs, document and passage are compared word by word. Words in
   50 equal ones or more go, if the passage is of a smaller document.

So the automaton alone says where a document may repeat something: a passage whose
phrase it does not report stays. A bucket gets no more text than it holds itself.

Defined results: null or blank text has no words and nothing removed. A text of
fewer than 50 words loses nothing. Rows that share an id count as one document, so
neither removes the other's words; a null id counts as larger than all others. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tickloom.llm import buckets as B
from tickloom.llm import grams


class _Run:
    """The words of a run of texts, their windows and the phrase each window chose."""

    def __init__(self, ids: pa.Array, raw, offsets, window: int, phrase: int):
        self.raw, self.text_offsets = raw, offsets
        self.ids = ids.fill_null(B.LAST_ID).to_numpy()
        self.words = grams.Words(raw, offsets)
        self.starts = grams.window_starts(self.words.offsets, window)
        windows = np.maximum(self.words.counts - window + 1, 0)
        self.owner = np.repeat(np.arange(len(windows)), windows)
        self.window, self.phrase = window, phrase

    @cached_property
    def rolling(self) -> grams.Rolling:
        return grams.Rolling(self.words.hash)

    def chosen(self) -> np.ndarray:
        """Hash of the phrase that each window chose."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        hashes = self.rolling.windows(self.phrase)
        return hashes[B.anchors(hashes, self.starts, self.window - self.phrase + 1)]

    def keys(self, windows: np.ndarray | slice = slice(None)) -> np.ndarray:
        starts = self.starts[windows]
        return self.rolling.spans(starts, starts + self.window) & ~B.ONE

    def split(self, text: int) -> list[bytes]:
        return self.raw[self.text_offsets[text] : self.text_offsets[text + 1]].tobytes().split()


def _runs(table: pa.Table, window: int, phrase: int):
    texts, ids = table.column_names.index("text"), table.column_names.index("doc_id")
    for doc_ids, raw, offsets in grams.slices(table, ids, texts):
        yield doc_ids, _Run(doc_ids, raw, offsets, window, phrase)


def _phrases(texts: DataFrame, parts: int, window: int, phrase: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        keys, docs = [], []
        for _, r in _runs(table, window, phrase):
            found, owner = r.chosen(), r.owner
            new = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))
            keys.append(found[new[: len(found)]])
            docs.append(r.ids[owner[new[: len(found)]]])
        bucket = table.column("bucket")[0].as_py()
        return B.pack_weighted(bucket, parts, np.concatenate(keys), np.concatenate(docs))

    return texts.groupBy("bucket").applyInArrow(run, "part int, bucket int, keys binary")


def _windows(texts: DataFrame, found: DataFrame, parts: int, window: int, phrase: int) -> DataFrame:
    """Hashes of the windows whose phrase recurs."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        known, _ = B.answered(answers)
        plain = known & ~B.LEVEL
        keys, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, r in _runs(table, window, phrase) if len(plain) else ():
            recurs = B.place_of(plain, r.chosen() & ~B.LEVEL) >= 0
            keys.append(r.keys(recurs))
            docs.append(r.ids[r.owner[recurs]])
        bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
        return B.pack_keys(bucket, parts, np.concatenate(keys), np.concatenate(docs))

    both = texts.groupBy("bucket").cogroup(found.groupBy("bucket"))
    return both.applyInArrow(run, B.PACKED)


PASSAGES = "bucket int, doc_id long, passage binary"


def _passages(texts: DataFrame, holders: DataFrame, window: int, phrase: int) -> DataFrame:
    """Text of the confirmed passages of the first documents, for each bucket that has them."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        wanted = [b"".join(told.column(c).to_pylist()) for c in ("keys", "docs", "holders")]
        keys, docs = np.frombuffer(wanted[0], np.uint64), np.frombuffer(wanted[1], np.int64)
        to = np.frombuffer(wanted[2], np.int32)
        order = np.argsort(keys)
        keys, docs, to = keys[order], docs[order], to[order]
        first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
        begin, distinct, owner = np.flatnonzero(first), keys[first], docs[first]
        counts = np.diff(np.append(begin, len(keys)))
        done = np.zeros(len(distinct), bool)
        table = table.filter(pc.is_in(table.column("doc_id"), pa.array(np.unique(docs))))
        out: list[tuple] = []
        for _, r in _runs(table, window, phrase):
            at = B.place_of(distinct, r.keys())
            mine = np.flatnonzero((at >= 0) & (owner[at] == r.ids[r.owner]) & ~done[at]) if len(distinct) else at[:0]
            _, once = np.unique(at[mine], return_index=True)  # the first place of each window
            mine = mine[np.sort(once)]
            at = at[mine]
            done[at] = True
            entry = np.repeat(begin[at], counts[at]) + grams.ranges(counts[at])
            holder, place = to[entry], np.repeat(mine, counts[at])
            order = np.lexsort((place, holder))
            holder, place = holder[order], place[order]
            new = (np.diff(holder, prepend=-1) != 0) | (np.diff(r.starts[place], prepend=-2) != 1)
            new |= np.diff(r.owner[place], prepend=-1) != 0
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(new))[: len(heads)] - 1
            from_byte = r.words.start[r.starts[place[heads]]].tolist()
            to_byte = r.words.end[r.starts[place[tails]] + window - 1].tolist()
            ids = r.ids[r.owner[place[heads]]].tolist()
            for h, i, a, b in zip(holder[heads].tolist(), ids, from_byte, to_byte):
                out.append((h, i, r.raw[a:b].tobytes()))
        kinds = (pa.int32(), pa.int64(), pa.binary())
        columns = zip(*out) if out else ((), (), ())
        return pa.table(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["bucket", "doc_id", "passage"]
        )

    both = texts.groupBy("bucket").cogroup(holders.groupBy("bucket"))
    return both.applyInArrow(run, PASSAGES)


def _spaced(words: list[bytes]) -> str:
    """Words between single spaces, one character per byte."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


class Shard:
    """Passages of a bucket and the automaton that finds their phrases.

    Of a passage, every (window - phrase + 1)-th phrase is in the automaton, so each
    of its windows contains one.
    """

    def __init__(self, docs: list[int], passages: list[bytes], window: int, phrase: int):
        import ahocorasick

        self.window = window
        self.docs = np.array(docs, np.int64)
        raw = np.frombuffer(b"".join(passages), np.uint8)
        sizes = np.fromiter(map(len, passages), np.int64, len(passages))
        words = grams.Words(raw, np.concatenate([[0], np.cumsum(sizes)]))
        self.hash, self.begin = words.hash, words.offsets
        places: dict[str, list[tuple[int, int]]] = {}
        for number, passage in enumerate(passages):
            some = passage.split()
            for at in range(0, len(some) - phrase + 1, window - phrase + 1):
                places.setdefault(_spaced(some[at : at + phrase]), []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for number, text in enumerate(places):
            self.automaton.add_word(text, number)
        self.automaton.make_automaton()
        self.width = np.fromiter(map(len, places), np.int64, len(places))
        self.counts = np.fromiter(map(len, places.values()), np.int64, len(places))
        self.first = np.cumsum(self.counts) - self.counts
        self.places = np.array([p for some in places.values() for p in some], np.int64).reshape(-1, 2)

    def _met(self, doc: int, words: list[bytes]) -> np.ndarray:
        """Distinct (passage, its first word's place in the document), of smaller documents."""
        found = list(self.automaton.iter(_spaced(words)))
        if not found:
            return np.zeros((0, 2), np.int64)
        end, which = np.array(found, np.int64).T
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(lengths + 1) - lengths
        at = np.searchsorted(begins, end - self.width[which] + 2)
        counts = self.counts[which]
        met = self.places[np.repeat(self.first[which], counts) + grams.ranges(counts)]
        met[:, 1] = np.repeat(at, counts) - met[:, 1]
        return np.unique(met[self.docs[met[:, 0]] < doc], axis=0)

    def repeated(self, doc: int, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Which words of a document lie in a window of a passage of a smaller document."""
        gone = np.zeros(len(words), dtype=bool)
        if len(words) < self.window or not len(self.docs):
            return gone
        for passage, at in self._met(doc, words).tolist():
            begin, end = self.begin[passage], self.begin[passage + 1]
            low, high = max(at, 0), min(at + end - begin, len(words))
            same = hashes[low:high] == self.hash[begin + low - at : begin + high - at]
            edges = np.concatenate([[-1], np.flatnonzero(~same), [len(same)]])
            for k in np.flatnonzero(np.diff(edges) > self.window).tolist():
                gone[low + edges[k] + 1 : low + edges[k + 1]] = True
        return gone


OUT = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept string"


def _removed(texts: DataFrame, passages: DataFrame, window: int, phrase: int) -> DataFrame:
    def spans(marked: np.ndarray) -> list[dict]:
        edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
        pairs = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
        return [{"start": a, "end": b} for a, b in pairs]

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        texts_of, docs_of = found.column("passage").to_pylist(), found.column("doc_id").to_pylist()
        shard = Shard(docs_of, texts_of, window, phrase)
        ids, counts, removed, kept = [], [], [], []
        for doc_ids, r in _runs(table, window, phrase):
            for text, doc in enumerate(r.ids.tolist()):
                words = r.split(text)
                mine = r.words.hash[r.words.offsets[text] : r.words.offsets[text + 1]]
                gone = shard.repeated(doc, words, mine)
                removed.append(spans(gone) if gone.any() else [])
                if removed[-1]:
                    words = [w for w, out in zip(words, gone.tolist()) if not out]
                kept.append(b" ".join(words))
            ids.extend(doc_ids.to_pylist())
            counts.append(r.words.counts)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                "spans": pa.array(removed, pa.list_(span)),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    both = texts.groupBy("bucket").cogroup(passages.groupBy("bucket"))
    return both.applyInArrow(run, OUT)


def remove_repeated_passages(
    docs: DataFrame,
    window: int = 50,
    phrase: int = 12,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, n_words, spans, kept`: removed runs of words, remaining words joined by a space."""
    texts, parts = B.bucketed(docs, id_col, text_col)
    found = B.recurring(_phrases(texts, parts, window, phrase))
    holders = B.first_holders(_windows(texts, found, parts, window, phrase))
    return _removed(texts, _passages(texts, holders, window, phrase), window, phrase)
