"""Prediction by partial matching over bytes, for several languages at once.

A language's context tree holds, for every context of up to `ORDER` bytes seen in its
sample, how often each byte followed. A byte is coded in the longest known context; if
it never followed there, an escape is coded and the next shorter context is tried, down
to the empty one and at last to 8 bits. With n bytes of q kinds seen in a context, a
byte seen c times has probability c / (n + q), the escape q / (n + q).

The statistics are frozen, so the code length of a byte in its context is a fixed
number. For each gram (context and byte) that any language has seen, the lengths in all
languages, escapes included, are worked out once. Scoring is then one look-up per byte;
only grams that no language has seen walk on to shorter contexts. Lengths are whole
multiples of 1/65536 bit, so sums do not depend on how texts are cut into runs.
"""

from __future__ import annotations

import numpy as np

ORDER = 4  # bytes of context
BIT = 65_536  # units of a code length
PIECE = 2_000_000  # positions times languages worked on at once

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def grams_of(raw: np.ndarray, offsets: np.ndarray, begin: int, end: int) -> np.ndarray:
    """For each byte in [begin, end): its `ORDER` bytes of context and itself, as one number.

    Bytes before the start of a text count as zero.
    """
    position = np.arange(begin, end)
    starts = offsets[np.searchsorted(offsets, position, side="right") - 1]
    code = raw[begin:end].astype(np.uint64)
    for back in range(1, ORDER + 1):
        there = position - back >= starts
        before = np.zeros(end - begin, np.uint64)
        before[there] = raw[position[there] - back]
        code |= before << np.uint64(8 * back)
    return code


def shortened(grams: np.ndarray, context: int) -> np.ndarray:
    """The grams with only `context` bytes of context."""
    return grams & np.uint64(2 ** (8 * (context + 1)) - 1)


class Table:
    """Positions of known numbers in a sorted list; -1 for others."""

    def __init__(self, known: np.ndarray):
        self.known = known
        bits = max(4, int(4 * len(known)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot = np.zeros(2**bits, np.int32)
        self.slot[self._place(known)] = np.arange(len(known), dtype=np.int32)

    def _place(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers * _SPREAD) >> self.shift

    def find(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(numbers), -1)
        at = self.slot[self._place(numbers)].astype(np.int64)
        other = np.flatnonzero(self.known[at] != numbers)
        wanted = numbers[other]
        found = np.minimum(np.searchsorted(self.known, wanted), len(self.known) - 1)
        at[other] = np.where(self.known[found] == wanted, found, -1)
        return at


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams with counts; distinct contexts with bytes and kinds seen."""
    known, counts = np.unique(grams, return_counts=True)
    contexts, first = np.unique(known >> np.uint64(8), return_index=True)
    if not len(known):
        return known, counts, contexts, counts, counts
    kinds = np.diff(np.append(first, len(known)))
    return known, counts, contexts, np.add.reduceat(counts, first), kinds


def fit(samples: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, ...]]:
    """Per context length from 0: grams, their lengths, contexts, their escapes.

    `samples` has bytes and offsets of the texts of each language. Lengths and escapes
    have a column per language; where a language does not know a context its escape is 0.
    """
    full = [grams_of(raw, offsets, 0, len(raw)) for raw, offsets in samples]
    levels: list[tuple[np.ndarray, ...]] = []
    for order in range(ORDER + 1):
        counted = [_counted(shortened(g, order)) for g in full]
        known = np.unique(np.concatenate([c[0] for c in counted]))
        contexts = np.unique(np.concatenate([c[2] for c in counted]))
        escapes = np.zeros((len(contexts), len(samples)), np.int64)
        # what a gram costs where its byte is not known in this context
        lengths = _shorter(levels, known, len(samples)).astype(np.int64)
        owner = np.searchsorted(contexts, known >> np.uint64(8))
        for column, (own, counts, own_contexts, seen, kinds) in enumerate(counted):
            at = np.searchsorted(contexts, own_contexts)
            total = seen + kinds
            escapes[at, column] = np.rint(np.log2(total / np.maximum(kinds, 1)) * BIT)
            lengths[:, column] += escapes[owner, column]
            group = np.searchsorted(own_contexts, own >> np.uint64(8))
            exact = np.rint(np.log2(total[group] / counts) * BIT) if len(own) else 0
            lengths[np.searchsorted(known, own), column] = exact
        levels.append((known, lengths.astype(np.int32), contexts, escapes.astype(np.int32)))
    return levels


def _shorter(levels: list[tuple[np.ndarray, ...]], grams: np.ndarray, columns: int) -> np.ndarray:
    """Lengths of grams in the contexts of the levels so far, the longest first."""
    if not levels:
        return np.full((len(grams), columns), 8 * BIT, np.int64)
    return Scorer(levels).lengths(grams)


class Scorer:
    """Code lengths under the trees that `fit` gave."""

    def __init__(self, levels: list[tuple[np.ndarray, ...]]):
        self.levels = [(Table(g), lengths, Table(c), escapes) for g, lengths, c, escapes in levels]
        self.columns = levels[0][1].shape[1]

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """A row per gram, a column per language, in 1/65536 bit."""
        out = np.zeros((len(grams), self.columns), np.int32)
        left = np.arange(len(grams))
        for order in range(len(self.levels) - 1, -1, -1):
            known, lengths, contexts, escapes = self.levels[order]
            some = shortened(grams[left], order)
            at = known.find(some)
            hit = at >= 0
            out[left[hit]] += lengths[at[hit]]
            left, some = left[~hit], some[~hit]
            if not len(left):
                return out
            at = contexts.find(some >> np.uint64(8))
            hit = at >= 0
            out[left[hit]] += escapes[at[hit]]
        out[left] += 8 * BIT
        return out

    def texts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each whole text in each language."""
        total = np.zeros((len(offsets) - 1, self.columns), np.int64)
        step = max(PIECE // self.columns, 1)
        for begin in range(0, len(raw), step):
            end = min(begin + step, len(raw))
            lengths = self.lengths(grams_of(raw, offsets, begin, end))
            first = int(np.searchsorted(offsets, begin, side="right")) - 1
            last = int(np.searchsorted(offsets, end, side="left"))
            inside = np.arange(first, last)
            starts = np.clip(offsets[inside], begin, end) - begin
            stops = np.clip(offsets[inside + 1], begin, end) - begin
            some = stops > starts
            total[inside[some]] += np.add.reduceat(lengths, starts[some], axis=0, dtype=np.int64)
        return total
