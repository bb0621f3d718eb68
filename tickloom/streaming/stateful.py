"""Positions over a stream that may come out of order, as keyed state with timers.

Every ticker keeps its position and the bars that still wait. A bar waits until the
watermark has passed it, so bars that are late by less than `late` are put in order, and of
repeated bars one is used. State is in the RocksDB store of the stream's checkpoint: a
stream that is stopped goes on where it was. One task works on a ticker in each batch; for
tickers too long for that there is `positions.position_stream`, which needs bars in order.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.positions import TradeRules, cents

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = (
    "ticker string, Date timestamp_ntz, Close double, decision string, in_position boolean, "
    "portfolio_value double, entry_date timestamp_ntz, entry_price double, holding_days long, "
    "pnl double, pnl_pct double, exit_reason string"
)
NAMES = [field.split(" ")[0] for field in OUT.split(", ")]
NO_TRADE = (None,) * 6


class Position(StatefulProcessor):
    """Folds the bars of a ticker in order of date, once the watermark has passed them."""

    def __init__(self, rules: TradeRules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.position = handle.getValueState(
            "position", "capital double, entry long, price double, held long"
        )
        self.waiting = handle.getListState("waiting", "at long, close double, decision string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first = None
        for some in rows:
            bars = list(zip(some["at"].tolist(), some["Close"].tolist(), some["decision"].tolist()))
            self.waiting.appendList(bars)
            first = min(first or bars[0], *bars)
        if first:
            self.handle.registerTimer(first[0] // 1000)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(tuple(bar) for bar in self.waiting.get())
        due = [bar for bar in waiting if bar[0] <= until]
        if not due:  # an earlier timer of this batch has had them
            return
        later = waiting[len(due) :]
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(later[0][0] // 1000)
        else:
            self.waiting.clear()
        state = tuple(self.position.get() or (self.rules.initial_capital, None, None, None))
        out, last = [], None
        for at, close, decision in due:
            if at != last:  # of repeats the smallest
                state, row = self._bar(state, at, close, decision)
                out.append((key[0], *row))
            last = at
        self.position.update(state)
        yield self._frame(out)

    def _bar(self, state: tuple, at: int, close: float, decision: str | None) -> tuple[tuple, tuple]:
        """State after a bar, and what the bar shows."""
        capital, entry, price, held = state
        trade = NO_TRADE
        if price is not None:
            held += 1
            full = held >= self.rules.holding_period
            if full or (decision == "HOLD" and held >= self.rules.minimum_hold):
                reason = "holding_period" if full else "decision_change"
                gain = (close - price) * (capital / price)
                trade = (entry, price, held, gain, (close - price) / price * 100, reason)
                capital *= close / price - self.rules.commission_rate
                entry = price = held = None
        if price is None and decision == "BUY":
            entry, price, held = at, close, 0
        value = capital if price is None else capital * (close / price)
        shown = (at, close, decision, price is not None, float(cents(value)))
        return (capital, entry, price, held), (*shown, *trade)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=NAMES)
        for name in ("Date", "entry_date"):
            frame[name] = pd.to_datetime(frame[name].astype("Int64"), unit="us")
        frame["holding_days"] = frame["holding_days"].astype("Int64")
        return frame

    def close(self) -> None:
        pass


def positions_in_time(
    signals: DataFrame, rules: TradeRules = TradeRules(), late: str = "1 hour"
) -> DataFrame:
    """One row per bar of a stream of `ticker, Date, Close, decision`, and the trade it closed.

    Rows come once the watermark (the newest date less `late`) has passed their bar; bars
    that are later than that are dropped and counted by Spark. Bars without a ticker, date or
    close are left out. Of bars with one date that with the smallest close is used.
    """
    at = F.col("Date").cast("timestamp")
    timed = (
        signals.filter("ticker is not null and Date is not null and Close is not null")
        .select("ticker", at.alias("_at"), F.col("Close").cast("double").alias("Close"), "decision")
        .withWatermark("_at", late)
        .select("ticker", "_at", F.unix_micros("_at").alias("at"), "Close", F.coalesce("decision", F.lit("")).alias("decision"))
    )
    return timed.groupBy("ticker").transformWithStateInPandas(
        Position(rules), OUT, outputMode="Append", timeMode="EventTime"
    )


def closed_trades(rows: DataFrame) -> DataFrame:
    """The trades among the rows of `positions_in_time`, one each."""
    return rows.filter("exit_reason is not null").select(
        "ticker",
        "entry_date",
        "entry_price",
        F.col("Date").alias("exit_date"),
        F.col("Close").alias("exit_price"),
        "holding_days",
        "pnl",
        "pnl_pct",
        "exit_reason",
    )


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)
