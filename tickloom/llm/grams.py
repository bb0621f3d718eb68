"""Word and byte windows of whole Arrow batches, as numpy arrays.

A batch of texts is one run of UTF-8 bytes with offsets. Hashes of all windows of
it come from one running sum (a polynomial hash modulo 2**64), so nothing here
loops over words or documents in Python.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

_SEEDS = np.random.default_rng(20240611)
_BYTE_VALUES = _SEEDS.integers(1, 2**63, 256, dtype=np.uint64) * 2 + 1
_BASE = int(_SEEDS.integers(2**40, 2**62)) * 2 + 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SLICE_BYTES = 2_000_000


def settle() -> None:
    """Give freed memory back: idle workers stay alive beside those of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offset of each text; null is empty."""
    if texts.null_count:
        binary = pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)
        texts = texts.fill_null(b"" if binary else "")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return _LOWER[raw]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (an invertible finaliser)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done, step = 1, base % 2**64
    while done < n:
        width = min(done, n - done)
        np.multiply(out[:width], np.uint64(step), out=out[done : done + width])
        done += width
        step = step * step % 2**64
    return out[:n]


class Rolling:
    """Hashes of spans of `values` (uint64) in constant time each."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_BASE_INVERSE, n + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of [start, end); equal spans anywhere have equal hashes."""
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hash of every window of `width`, by start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.back[:n])


def byte_values(raw: np.ndarray) -> np.ndarray:
    """The 64-bit value that stands for each byte in a rolling hash."""
    return _BYTE_VALUES[raw]


class Words:
    """Words (`[^\\x20\\x09-\\x0D]+`) of each text: byte spans, hashes, counts.

    `between`, 256 flags, names other bytes that separate words.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE):
        n = len(raw)
        solid = ~between[raw]
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        begin = offsets[:-1][np.diff(offsets) > 0]
        starts[begin] |= solid[begin]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        last = offsets[1:][np.diff(offsets) > 0] - 1
        ends[last] |= solid[last]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        # words before each text
        self.offsets = np.searchsorted(self.start, offsets) if n else np.zeros_like(offsets)
        self.raw = raw
        self._hash = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = np.empty(len(self.start), dtype=np.uint64)
            first = 0
            while first < len(self.start):  # some bytes at a time, as sums take eight each
                a = self.start[first]
                last = max(int(np.searchsorted(self.end, a + SLICE_BYTES, side="right")), first + 1)
                some = slice(first, last)
                rolling = Rolling(byte_values(self.raw[a : self.end[last - 1]]))
                self._hash[some] = rolling.spans(self.start[some] - a, self.end[some] - a)
                first = last
        return self._hash

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def window_starts(offsets: np.ndarray, width: int) -> np.ndarray:
    """Starts of all windows of `width` items that stay within one text."""
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(offsets[:-1] - before, counts)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before, counts)


def slices(batch: pa.RecordBatch | pa.Table, ids: int = 0, texts: int = 1, size: int = SLICE_BYTES):
    """Ids (Arrow), bytes and offsets of runs of whole texts, each about `size` bytes long.

    The arrays of a run take some dozens of times its bytes, so a batch is worked
    through in runs; a longer text is a run of its own.
    """
    tables = [batch] if isinstance(batch, pa.RecordBatch) else batch.to_batches()
    for part in tables:
        column = part.column(ids)
        raw, offsets = text_bytes(part.column(texts))
        begin = 0
        while begin < len(column):
            limit = offsets[begin] + size
            end = int(np.searchsorted(offsets, limit, side="right")) - 1
            end = min(max(end, begin + 1), len(column))
            yield (
                column.slice(begin, end - begin),
                raw[offsets[begin] : offsets[end]],
                offsets[begin : end + 1] - offsets[begin],
            )
            begin = end
    settle()
