"""Personal data: patterns, and a character-level BiLSTM-CRF that adds to them.

The base spans come from fixed patterns with their checks. The network (`lstm_crf.py`)
learns, on the driver, from a bounded sample: the base spans of its texts, and forms
the patterns miss, planted in pieces of them beside lookalikes (`planted.py`). It decodes
overlapping windows; where windows disagree, each character takes the tag of the
window whose middle is nearest, so a span is cut from one tag sequence of the whole
text. A span of it is widened to whole runs of letters and digits, and joins the base
ones if it passes the check of its kind (`plausible`) and overlaps none of them.

Every form has a digit, an at sign, the word "dot" or a bracketed "at". So windows are
laid over the stretches within a window's length of such a sign; the rest of a text
cannot hold a span. This depends on the characters alone.

The sample: at most `SAMPLE` documents with an id and a digit or an at sign, of at
most `SAMPLE_CHARS` characters, the first by a hash of their id; `SAMPLE_WINDOWS` of
their windows, and those of `PLANTED` pieces.

Defined results: null text is empty and has no spans. Repeated rows and null ids are
treated like any other. Without a sample nothing is added to the base spans. An
empty table gives an empty result. Offsets count code points, ends are exclusive.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import lstm_crf
from tickloom.llm.planted import planted

# Fixed values.
KINDS = ("email", "ip", "card", "phone")
CARD_DIGITS = (14, 19)
PHONE_DIGITS = (10, 15)

SAMPLE = 1_500
SAMPLE_CHARS = 30_000
SAMPLE_WINDOWS = 1_500
PLANTED = 4_000
WINDOWS_AT_ONCE = 2_000

_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that fails from its first digit fails from the others, too
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_SPELLED = re.compile(r"[(\[{<] ?(?:at|dot) ?[)\]}>]|\bdot\b", re.ASCII | re.IGNORECASE)
_AT = re.compile(r"\w\s?(?:@|[(\[{<] ?at ?[)\]}>]| at )\s?\w.*(?:\.|dot).*[a-z]$", re.ASCII | re.IGNORECASE)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, one at sign at a time, in linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and not _NOT_LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))


def _digits(match: str) -> list[int]:
    return [ord(c) - 48 for c in match if "0" <= c <= "9"]


def _luhn(digits: list[int]) -> bool:
    twice = (2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """`start, kind, end` of every match that passes its check, in order."""
    if not _TRIGGER.search(text):
        return []
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.minimum(points, lstm_crf.ALPHABET - 1).astype(np.int16)


def windows(codes: np.ndarray, shape: lstm_crf.Shape, spelled: list[int] = ()) -> np.ndarray:
    """Starts of the overlapping windows over all stretches that may hold a span.

    `spelled` are the places of spelled-out signs, beside digits and at signs.
    """
    hit = np.flatnonzero(((codes >= 48) & (codes <= 57)) | (codes == 64))
    hit = np.concatenate([hit, np.array(spelled, np.int64)])
    if not len(hit):
        return hit
    near = np.unique(np.concatenate([hit // shape.stride - 1, hit // shape.stride]))
    return near[near >= 0] * shape.stride if len(codes) > shape.window else near[:1] * 0


def _spelled(text: str) -> list[int]:
    return [m.start() for m in _SPELLED.finditer(text)]


def _laid(codes: np.ndarray, starts: np.ndarray, shape: lstm_crf.Shape):
    at = starts[:, None] + np.arange(shape.window)
    mask = at < len(codes)
    return np.where(mask, codes[np.minimum(at, len(codes) - 1)], lstm_crf.PAD), mask


def _tags_of(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """0 outside, 2k + 1 at the start of kind k, 2k + 2 inside; the earlier span wins."""
    tags = np.zeros(n, dtype=np.int8)
    for start, kind, end in spans:
        if not tags[start:end].any():
            tags[start:end] = 2 * kind + 2
            tags[start] = 2 * kind + 1
    return tags


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """Weights trained on the base spans of the sample; None where there is none."""
    shape = lstm_crf.Shape()
    text = F.col(text_col)
    usable = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).filter(
        F.col("doc_id").isNotNull()
        & F.col("text").rlike("[0-9@]")
        & (F.length("text") <= SAMPLE_CHARS)
    )
    ids = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = usable.join(F.broadcast(ids), "doc_id").orderBy("doc_id", "text").toArrow()
    texts = rows.column("text").to_pylist()
    laid = _labelled([(t, base_spans(t)) for t in texts], shape)
    if laid is None:
        return None
    some = np.random.default_rng(5).permutation(len(laid[0]))[:SAMPLE_WINDOWS]
    pieces = _labelled(planted(texts, PLANTED, seed=17), shape)
    chars, masks, tags = (np.concatenate([x[some], more]) for x, more in zip(laid, pieces))
    return lstm_crf.train(chars, masks, tags.astype(np.int64), shape, epochs=6)


def _labelled(texts: list[tuple[str, list]], shape: lstm_crf.Shape):
    """Characters, masks and tags of all windows of texts with their spans; base spans go first."""
    chars, masks, tags = [], [], []
    for value, spans in texts:
        codes = _codes(value)
        starts = windows(codes, shape, _spelled(value))
        if len(starts):
            laid, mask = _laid(codes, starts, shape)
            chars.append(laid)
            masks.append(mask)
            gold = _tags_of(len(codes), base_spans(value) + spans)
            tags.append(np.where(mask, _laid(gold, starts, shape)[0], 0))
    return tuple(np.concatenate(x) for x in (chars, masks, tags)) if chars else None


def reconciled(codes_length: int, starts: np.ndarray, tags: np.ndarray, mask: np.ndarray):
    """One tag per character: from the covering window whose middle is nearest, the earlier if tied."""
    out = np.zeros(codes_length, dtype=np.int8)
    nearest = np.full(codes_length, np.iinfo(np.int64).max)
    width = tags.shape[1]
    distance = np.abs(2 * np.arange(width) - (width - 1))
    for start, row, on in zip(starts.tolist(), tags, mask):
        end = start + int(on.sum())
        better = distance[: end - start] < nearest[start:end]
        out[start:end][better] = row[: end - start][better]
        nearest[start:end][better] = distance[: end - start][better]
    return out


def tagged_spans(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """`start, kind, end` of every run of one kind; a start tag begins a new run."""
    kind = (tags.astype(np.int64) + 1) // 2
    begins = kind > 0
    begins[1:] &= (kind[1:] != kind[:-1]) | (tags[1:] % 2 == 1)
    ends = kind > 0
    ends[:-1] &= (kind[1:] != kind[:-1]) | begins[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return [(a, int(kind[a]) - 1, b) for a, b in zip(first.tolist(), last.tolist())]


def plausible(kind: int, span: str) -> bool:
    """The check of a span that the network found: as that of the patterns, whatever separates."""
    if kind == 0:
        return _AT.search(span) is not None
    if kind == 1:
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(int(p[:9]) <= 255 for p in parts)
    if kind == 2:
        digits = _digits(span)
        return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and _luhn(digits)
    digits = sum(c in "0123456789OIl" for c in span)
    return PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1] and not re.search("[A-HJ-NP-Za-km-z]", span)


def _whole(text: str, start: int, end: int) -> tuple[int, int]:
    """The span widened to whole runs of letters and digits."""
    while start > 0 and text[start - 1].isalnum() and text[start].isalnum():
        start -= 1
    while end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
        end += 1
    return start, end


def _added(text: str, base, codes, starts, tags, mask) -> list[tuple[int, int, int]]:
    taken = np.zeros(len(codes) + 1, dtype=bool)
    for start, _, end in base:
        taken[start:end] = True
    out = []
    for start, kind, end in tagged_spans(reconciled(len(codes), starts, tags, mask)):
        if taken[start:end].any():
            continue
        start, end = _whole(text, start, end)
        if plausible(kind, text[start:end]) and not taken[start:end].any():
            out.append((start, kind, end))
            taken[start:end] = True
    return out


SPANS = "doc_id long, kind array<string>, start array<long>, end array<long>, base array<boolean>"


def find_spans(
    docs: DataFrame, weights, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, kind, start, end, base`: all spans of every text, in order, as arrays."""
    shape = lstm_crf.Shape()
    plain = (asdict(shape), weights)
    shared = docs.sparkSession.sparkContext.broadcast(plain)  # some kilobytes

    def spans_of(texts: list[str]) -> list[list[tuple[int, int, int, bool]]]:
        fields, w = shared.value
        shape = lstm_crf.Shape(**fields)
        out = [[(*span, True) for span in base_spans(text)] for text in texts]
        if w is None:
            return out
        waiting: list[tuple] = []

        def decode() -> None:
            laid = [_laid(codes, starts, shape) for _, codes, starts in waiting]
            chars = np.concatenate([x[0] for x in laid])
            mask = np.concatenate([x[1] for x in laid])
            tags = np.concatenate(
                [
                    lstm_crf.decode(w, shape, chars[a : a + WINDOWS_AT_ONCE], mask[a : a + WINDOWS_AT_ONCE])
                    for a in range(0, len(chars), WINDOWS_AT_ONCE)
                ]
            )
            done = 0
            for i, codes, starts in waiting:
                part = slice(done, done + len(starts))
                done += len(starts)
                base = [span[:3] for span in out[i]]
                new = _added(texts[i], base, codes, starts, tags[part], mask[part])
                out[i] = sorted(out[i] + [(*span, False) for span in new])
            waiting.clear()

        held = 0
        for i, text in enumerate(texts):
            spelled = _spelled(text)
            if not spelled and not _TRIGGER.search(text):
                continue
            codes = _codes(text)
            starts = windows(codes, shape, spelled)
            waiting.append((i, codes, starts))
            held += len(starts)
            if held >= WINDOWS_AT_ONCE:
                decode()
                held = 0
        if waiting:
            decode()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans_of([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[KINDS[s[1]] for s in f] for f in found], pa.list_(pa.string())),
                    pa.array([[s[0] for s in f] for f in found], pa.list_(pa.int64())),
                    pa.array([[s[2] for s in f] for f in found], pa.list_(pa.int64())),
                    pa.array([[s[3] for s in f] for f in found], pa.list_(pa.bool_())),
                ],
                ["doc_id", "kind", "start", "end", "base"],
            )

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, SPANS)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of `find_spans` with a network fitted to the same documents."""
    return find_spans(docs, fit(docs, id_col, text_col), id_col, text_col)
