"""Repair of damaged conversations: cheapest edits that give a legal order of roles.

Rows of a conversation are taken by turn. The first fault of a row counts: `blank` (no
character but spaces), `duplicate` (role and text seen earlier in it), `truncated` (the
last character that is no space ends no sentence). Kept rows cost 0; another role (user or
assistant) 3; deleting 4, which blank and duplicate rows need; inserting an empty user or
assistant row 3; a truncated row that stays 3. The roles that remain begin with the letters
of `(s?(ua)+)?`. Of the cheapest repairs the one whose audit (first letters of Keep,
Rerole, Delete, Insert) comes first in ASCII order is taken.

Steps: each conversation becomes a signature, a letter a row; distinct signatures are put
in order of their ends and solved in a suffix-shared automaton (`repair_dawg.py`), each
range of them by one; audits go back to the rows, which are read in order once more.
Neither pass holds more of a conversation than a letter a row, and each of its rows is
sent alone, so long conversations are streamed. Ranges share no nodes: a suffix that
begins a range is solved once more there.

Defined results: a null id is a conversation of its own; null turns come first and do not
count as gaps; null role and text are one space. Rows of one turn are ordered by role, then
text. A role's first letter decides; other letters than s, u and a, and empty roles, fit
nowhere. Repeated rows are duplicates. A conversation all of whose rows are marked as
gone keeps its row of zeros. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACES, kept
from tickloom.llm.repair_dawg import ROLE_AFTER, Automaton

SOLVED = "signature string, cost long, audit string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
FOUND = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", signature string"
REPAIRED = (
    "conv_id long, "
    + ", ".join(f"{c} long" for c in COUNTS)
    + ", cost long, audit string, repaired_sha256 string"
)
# Fixed values.
LEGAL = {"su", "ua", "au"}
END_OF_SENTENCE = ".!?"


def damaged(conversations: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text, gone`: rows after the damage their hash names.

    Of every 20 rows one is gone, one is emptied, one loses its `.!?`, one stands twice
    and one becomes a user's.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(F.concat_ws(":", *name)) % 20).alias("damage"),
    )
    text = (
        F.when(F.col("damage") == 1, "")
        .when(F.col("damage") == 2, F.translate("text", END_OF_SENTENCE, ""))
        .otherwise(F.col("text"))
    )
    times = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("damage") == 0).alias("gone"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """Rows with `key` (of role and text), `state` (blank, truncated or ok), `later`.

    `later`: an earlier turn of the conversation has the same role and text. Equal rows of
    one turn stand side by side, which the reading in order sees.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    state = (
        F.when(trimmed == "", "b")
        .when(F.right(trimmed, F.lit(1)).isin(*END_OF_SENTENCE), "o")
        .otherwise("t")
    )
    pair = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    rows = rows.withColumns({"key": F.unhex(F.sha2(pair, 256)), "state": state})
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = (
        rows.filter(~F.col("gone"))
        .groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k"))
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first < last")
        .drop("last")
    )
    found = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    return found.withColumn("later", F.coalesce(F.col("first") < place, F.lit(False))).drop("c", "k", "first")


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    """Conversations whole in their partition and in order of turn, role and text."""
    order = ["conv_id", *before, "turn", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`FOUND` of each conversation, from rows in order."""
    current, open_ = None, False
    counts: dict[str, int] = {}
    letters: list[str] = []
    turns = [None, None, 0, None]  # least, largest, distinct, last
    before = (None, None)  # turn and key of the row before
    initial = None
    done: list[tuple] = []

    def close() -> None:
        low, high, distinct, _ = turns
        counts["gaps"] = high - low + 1 - distinct if distinct else 0
        done.append((current, *(counts[c] for c in COUNTS), "".join(letters)))

    def out() -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * (len(COUNTS) + 2)
        kinds = [pa.int64()] * (len(COUNTS) + 1) + [pa.string()]
        names = ["conv_id", *COUNTS, "signature"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        for conv, turn, role, gone, key, state, later in zip(*(c.to_pylist() for c in batch.columns)):
            if not open_ or conv != current:
                if open_:
                    close()
                current, open_ = conv, True
                counts = dict.fromkeys(COUNTS, 0)
                letters, turns, before, initial = [], [None, None, 0, None], (None, None), None
            if gone:
                continue
            if turn is not None and turn != turns[3]:
                turns = [turn if turns[0] is None else turns[0], turn, turns[2] + 1, turn]
            if letters and initial + role[:1] not in LEGAL:
                counts["illegal"] += 1
            initial = role[:1]
            letter = initial if initial and initial in "sua" else "x"
            if state == "b":
                counts["blank"] += 1
                letter = "d"
            elif later or (turn, key) == before:
                counts["duplicate"] += 1
                letter = "d"
            elif state == "t":
                counts["truncated"] += 1
                letter = letter.upper()
            letters.append(letter)
            before = (turn, key)
        yield out()
        done.clear()
    if open_:
        close()
        yield out()


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`SOLVED` of signatures that come in order of their ends."""
    automaton = Automaton()
    for batch in batches:
        signatures = batch.column(0).to_pylist()
        costs, audits = zip(*map(automaton.repair, signatures)) if signatures else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["signature", "cost", "audit"],
        )


class _Writing:
    """The repaired conversation, hashed row by row as its edits are carried out."""

    def __init__(self, counts: tuple, cost: int, audit: str):
        self.row, self.audit = (*counts, cost, audit), audit
        self.at, self.state, self.hash, self.empty = 0, 0, hashlib.sha256(), True

    def _put(self, role: bytes, text: bytes) -> None:
        self.hash.update((b"" if self.empty else b"\n") + role + b":" + text)
        self.empty = False

    def _other(self, text: bytes) -> None:
        self.state = 3 if self.state == 2 else 2
        self._put(b"assistant" if self.state == 3 else b"user", text)

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._other(b"")
            self.at += 1

    def take(self, role: bytes, text: bytes) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = ROLE_AFTER[self.state][role[:1].decode()]
            self._put(role, text)
        elif edit == "R":
            self._other(text)

    def done(self) -> tuple:
        self.inserts()
        return (*self.row, self.hash.hexdigest())


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`REPAIRED`, from rows in order, each conversation led by the row of its audit."""
    writing, done = None, []
    names = ["conv_id", *COUNTS, "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * (len(COUNTS) + 2) + [pa.string()] * 2

    def out() -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        for audit, cost, counts, conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is None:
                writing.take(role, text)
                continue
            if writing:
                done.append(writing.done())
            writing = _Writing((conv, *(counts[c] for c in COUNTS)), cost, audit)
        yield out()
        done.clear()
    if writing:
        done.append(writing.done())
        yield out()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """`REPAIRED` for every conversation of `conv_id, turn, role, text, gone`."""
    read = ["conv_id", "turn", "role", "gone", "key", "state", "later"]
    found = kept(_in_order(_faults(rows)).select(*read).mapInArrow(_read, FOUND))
    ends = F.reverse("signature")
    solved = (
        found.select("signature")
        .distinct()
        .repartitionByRange(ends)
        .sortWithinPartitions(ends)
        .mapInArrow(_solve, SOLVED)
    )
    leads = found.join(solved, "signature").select(
        "conv_id",
        F.lit(0).alias("part"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit("").alias("text"),
        "audit",
        "cost",
        F.struct(*COUNTS).alias("counts"),
    )
    texts = rows.filter(~F.col("gone")).select(
        "conv_id", F.lit(1).alias("part"), "turn", "role", "text"
    )
    return (
        _in_order(leads.unionByName(texts, allowMissingColumns=True), "part")
        .select(
            "audit",
            "cost",
            "counts",
            "conv_id",
            F.col("role").cast("binary").alias("role"),
            F.col("text").cast("binary").alias("text"),
        )
        .mapInArrow(_write, REPAIRED)
    )
