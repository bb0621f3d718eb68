"""Turning decisions into positions, trades and an equity curve.

The position of a bar depends on all bars before it, yet it has few states: flat,
or held for 0 .. holding_period - 1 bars. So a chunk of a ticker can be summed
up without knowing its start: for every state it may start in, the state it ends
in. Three steps follow from that.

1. `chunk_outcomes`, per (ticker, chunk): end state for every start state.
2. `chunk_starts`, per ticker: walk the outcomes, one row per chunk, and note the
   state each chunk really starts in.
3. `replay`, per (ticker, chunk): values and trades, bar by bar.

No step needs more than one chunk of bars in memory. Capital is multiplied by
`exit / entry - commission` per round trip, so capital, last value and peak can
be carried along as well.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.chunks import CHUNK, BarGrid
from tickloom.schemas import TRADE

# The code below goes to the Python workers with the job, so that executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class TradeRules:
    initial_capital: float = 1_000_000.0
    holding_period: int = 20
    commission_rate: float = 0.001
    minimum_hold: int = 3  # bars before a HOLD decision may close the position


class _Chunk:
    """The bars of one chunk with what the rules need to know about them."""

    def __init__(self, pdf: pd.DataFrame, rules: TradeRules):
        pdf = pdf.sort_values("Date", kind="stable")
        self.rules = rules
        self.date = pdf["Date"].to_numpy()
        self.close = pdf["Close"].to_numpy(dtype=float)
        self.decision = pdf["decision"].to_numpy()
        self.size = len(pdf)
        self.next_buy = self._next(self.decision == "BUY")
        self.next_hold = self._next(self.decision == "HOLD")

    def _next(self, mask: np.ndarray) -> np.ndarray:
        """Index of the first true entry at or after each index; `size` if none."""
        where = np.where(mask, np.arange(self.size), self.size)
        following = np.minimum.accumulate(where[::-1])[::-1]
        return np.append(following, self.size)

    def exit_after(self, at: int, held: int) -> int:
        """Bar that closes a position held for `held` bars before bar `at`."""
        last = at + max(self.rules.holding_period - held, 1) - 1
        allowed = at + max(self.rules.minimum_hold - held, 1) - 1
        return min(last, self.next_hold[min(allowed, self.size)], self.size)

    def entry_from(self, at: int) -> int:
        return int(self.next_buy[min(at, self.size)])

    def trades_from(self, entry: int) -> Iterator[tuple[int, int]]:
        """(entry, exit) of each trade from `entry` on; an open one exits at `size`."""
        while entry < self.size:
            close = self.exit_after(entry + 1, 0)
            yield entry, close
            entry = self.entry_from(close)


def cents(value: np.ndarray) -> np.ndarray:
    """Half-up rounding of the number as written. It keeps order, so it may follow a maximum."""
    value = np.asarray(value, dtype=float)
    scaled = np.abs(value) * 100
    out = np.copysign(np.floor(scaled + 0.5) / 100, value)
    # Binary arithmetic is not to be trusted near a tie.
    near = np.isfinite(scaled) & (np.abs(scaled - np.floor(scaled) - 0.5) <= scaled * 1e-15 + 1e-12)
    for i in zip(*np.nonzero(near)) if value.ndim else ([()] if near else []):
        written = Decimal(repr(float(value[i])))
        out[i] = float(written.quantize(Decimal("0.01"), ROUND_HALF_UP))
    return out + 0.0


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


# State numbers: 0 .. holding_period - 1 = bars held so far; holding_period = flat.
_OUTCOMES = _fields(
    ticker=T.StringType(),
    chunk=T.LongType(),
    bars=T.LongType(),
    last_close=T.DoubleType(),
    end_state=T.ArrayType(T.IntegerType()),
    # Of the position held at the start: highest close while it is held, and the
    # close it is sold at (null if it is kept).
    held_top=T.ArrayType(T.DoubleType()),
    sold_at=T.ArrayType(T.DoubleType()),
    # From the sale on, relative to the capital after it: factor and highest value.
    growth=T.ArrayType(T.DoubleType()),
    growth_top=T.ArrayType(T.DoubleType()),
    # Entry of a position opened in the chunk and still held at its end.
    entry_date=T.ArrayType(T.TimestampNTZType()),
    entry_price=T.ArrayType(T.DoubleType()),
)

_STARTS = _fields(
    ticker=T.StringType(),
    chunk=T.LongType(),
    is_last=T.BooleanType(),
    held=T.IntegerType(),  # null = flat
    entry_date=T.TimestampNTZType(),
    entry_price=T.DoubleType(),
    capital=T.DoubleType(),
    bars_before=T.LongType(),
    value_before=T.DoubleType(),
    peak_before=T.DoubleType(),
)

_REPLAY = _fields(
    ticker=T.StringType(),
    chunk=T.LongType(),
    Date=T.TimestampNTZType(),
    Close=T.DoubleType(),
    decision=T.StringType(),
    in_position=T.BooleanType(),
    value=T.DoubleType(),
    trades=T.ArrayType(TRADE),
    bar_number=T.LongType(),
    portfolio_value=T.DoubleType(),
    previous=T.DoubleType(),
    peak=T.DoubleType(),
)


@dataclass(frozen=True)
class _Fate:
    """What becomes of the capital at work from a bar on."""

    end: int  # end state
    growth: float
    top: float
    kept: int | None  # entry bar of a position still held at the end


def _outcome(chunk: _Chunk) -> dict[str, list]:
    rules, flat = chunk.rules, chunk.rules.holding_period
    # Chains from different start states soon meet, so each entry is followed once.
    known = {chunk.size: _Fate(flat, 1.0, 1.0, None)}

    def follow(entry: int) -> _Fate:
        path = []
        at = entry
        while at not in known:
            out = chunk.exit_after(at + 1, 0)
            top = float(chunk.close[at:out].max() / chunk.close[at])
            if out >= chunk.size:
                known[at] = _Fate(chunk.size - 1 - at, 1.0, top, at)
                break
            path.append((at, out, top))
            at = chunk.entry_from(out)
        for at, out, top in reversed(path):
            rest = known[chunk.entry_from(out)]
            gain = float(chunk.close[out] / chunk.close[at]) - rules.commission_rate
            known[at] = _Fate(
                rest.end, gain * rest.growth, max(top, gain * max(rest.top, 1.0)), rest.kept
            )
        return known[entry]

    rows: dict[str, list] = {
        name: []
        for name in _OUTCOMES.names
        if name not in ("ticker", CHUNK, "bars", "last_close")
    }
    for state in range(flat + 1):
        out = 0 if state == flat else chunk.exit_after(0, state)
        if out >= chunk.size:  # held through the whole chunk
            fate = _Fate(state + chunk.size, 1.0, 1.0, None)
        else:
            fate = follow(chunk.entry_from(out))
        sold = state != flat and out < chunk.size
        rows["end_state"].append(fate.end)
        rows["held_top"].append(float(chunk.close[:out].max()) if out else None)
        rows["sold_at"].append(float(chunk.close[out]) if sold else None)
        rows["growth"].append(fate.growth)
        rows["growth_top"].append(max(fate.top, 1.0))
        kept = fate.kept
        rows["entry_date"].append(None if kept is None else pd.Timestamp(chunk.date[kept]))
        rows["entry_price"].append(None if kept is None else float(chunk.close[kept]))
    return rows


def chunk_outcomes(bars: DataFrame, rules: TradeRules) -> DataFrame:
    """One row per (ticker, chunk), with arrays indexed by start state."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        chunk = _Chunk(pdf, rules)
        row = {
            "ticker": key[0],
            CHUNK: key[1],
            "bars": chunk.size,
            "last_close": float(chunk.close[-1]),
        }
        return pd.DataFrame([row | _outcome(chunk)])

    return bars.groupBy("ticker", CHUNK).applyInPandas(run, _OUTCOMES)


class _Walker:
    """Position and capital of one ticker between two chunks."""

    def __init__(self, rules: TradeRules, r):
        self.rules, self.flat = rules, rules.holding_period
        self.state = self.flat if _missing(r.from_held) else int(r.from_held)
        self.entry_date, self.entry_price = r.from_entry_date, r.from_entry_price
        self.capital = rules.initial_capital if _missing(r.from_capital) else r.from_capital
        self.bars = 0 if _missing(r.from_bars_before) else int(r.from_bars_before)
        self.value, self.peak = r.from_value_before, r.from_peak_before

    def row(self, r) -> tuple:
        held = None if self.state == self.flat else self.state
        position = (held, self.entry_date, self.entry_price, self.capital)
        return (r.ticker, r.chunk, r.is_last, *position, self.bars, self.value, self.peak)

    def pass_chunk(self, r) -> None:
        state, tops = self.state, [] if _missing(self.peak) else [self.peak]
        held = state != self.flat
        if held:
            # A position sold on the first bar has no bar of its own here.
            if not _missing(r.held_top[state]):
                tops.append(self.capital * (r.held_top[state] / self.entry_price))
            if not _missing(r.sold_at[state]):
                sold = r.sold_at[state] / self.entry_price
                self.capital *= sold - self.rules.commission_rate
                held = False
        if not held:
            tops.append(self.capital * r.growth_top[state])
            self.capital *= r.growth[state]
            self.entry_date = self.entry_price = None
            if r.end_state[state] != self.flat:
                self.entry_date = pd.Timestamp(r.entry_date[state])
                self.entry_price = float(r.entry_price[state])
        self.state = int(r.end_state[state])
        self.bars, self.peak, self.value = self.bars + r.bars, max(tops), self.capital
        if self.state != self.flat:
            self.value = self.capital * (r.last_close / self.entry_price)


def _missing(value) -> bool:
    return value is None or pd.isna(value)


def _walk(outcomes: DataFrame, rules: TradeRules, initial: DataFrame | None, ends: bool) -> DataFrame:
    """Walk each ticker's outcomes in order; streams over sorted rows.

    Gives the state before each chunk, or with `ends` the state after the last.
    """
    following = F.lead(CHUNK).over(Window.partitionBy("ticker").orderBy(CHUNK))
    carried = [f for f in _STARTS.fields if f.name not in ("ticker", CHUNK, "is_last")]
    if initial is None:
        before = [F.lit(None).cast(f.dataType).alias(f"from_{f.name}") for f in carried]
        known = outcomes.select("*", *before)
    else:
        names = [F.col(f.name).alias(f"from_{f.name}") for f in carried]
        known = outcomes.join(initial.select("ticker", *names), "ticker", "left")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walker = ticker = None
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if walker is None or r.ticker != ticker:
                    walker, ticker = _Walker(rules, r), r.ticker
                if not ends:
                    rows.append(walker.row(r))
                walker.pass_chunk(r)
                if ends and r.is_last:
                    rows.append(walker.row(r))
            out = pd.DataFrame(rows, columns=_STARTS.names)
            yield out.astype({"held": "Int32", "entry_date": "datetime64[us]"}).astype(
                {name: "float64" for name in ("entry_price", "value_before", "peak_before")}
            )

    ordered = (
        known.withColumn("is_last", following.isNull())
        .repartition("ticker")
        .sortWithinPartitions("ticker", CHUNK)
    )
    return ordered.mapInPandas(walk, _STARTS)


def chunk_starts(
    outcomes: DataFrame, rules: TradeRules, initial: DataFrame | None = None
) -> DataFrame:
    """State and capital with which each chunk starts."""
    return _walk(outcomes, rules, initial, ends=False)


def end_states(
    signals: DataFrame, grid: BarGrid, rules: TradeRules, initial: DataFrame | None = None
) -> DataFrame:
    """One row per ticker: state and capital after its last bar, to start from later."""
    outcomes = chunk_outcomes(_chunked(signals, grid), rules)
    return _walk(outcomes, rules, initial, ends=True)


def _chunked(signals: DataFrame, grid: BarGrid) -> DataFrame:
    columns = ["ticker", grid.chunk().alias(CHUNK), "Date", "Close", "decision"]
    return signals.select(*columns).repartition("ticker", CHUNK)


def _replay_chunk(chunk: _Chunk, start) -> pd.DataFrame:
    rules, size = chunk.rules, chunk.size
    entry_price = np.full(size, np.nan)  # of the position held at the end of the bar
    factor = np.ones(size)
    trades: list[list | None] = [None] * size

    def record(out: int, entry_date, price: float, held: int, capital: float, reason: str):
        close = float(chunk.close[out])
        at_end = reason == "end_of_data"
        trade = {
            "entry_date": pd.Timestamp(entry_date),
            "entry_price": price,
            "exit_date": pd.Timestamp(chunk.date[out]),
            "exit_price": close,
            "holding_days": held,
            "pnl": 0.0 if at_end else (close - price) * (capital / price),
            "pnl_pct": (close - price) / price * 100,
            "exit_reason": reason,
        }
        trades[out] = [*(trades[out] or []), trade]

    # Positions in order: the one held at the start, then those opened here.
    first, opened = 0, []
    if not pd.isna(start.held):
        first = chunk.exit_after(0, int(start.held))
        opened.append((-1, first, start.entry_date, float(start.entry_price), int(start.held)))
    for entry, out in chunk.trades_from(chunk.entry_from(first)):
        opened.append((entry, out, chunk.date[entry], float(chunk.close[entry]), -entry - 1))

    capital = float(start.capital)
    for entry, out, date, price, before in opened:
        entry_price[max(entry, 0) : out] = price
        if out < size:
            held = before + out + 1
            reason = "holding_period" if held >= rules.holding_period else "decision_change"
            record(out, date, price, held, capital, reason)
            factor[out] = chunk.close[out] / price - rules.commission_rate
            capital *= factor[out]
        elif start.is_last:
            record(size - 1, date, price, before + size, capital, "end_of_data")

    in_position = ~np.isnan(entry_price)
    running = float(start.capital) * np.cumprod(factor)
    paid = np.where(in_position, entry_price, chunk.close)
    value = running * (chunk.close / paid)
    shown = cents(value)
    peak = np.fmax(np.maximum.accumulate(shown), cents(np.float64(start.peak_before)))
    return pd.DataFrame(
        {
            "ticker": start.ticker,
            CHUNK: start.chunk,
            "Date": chunk.date,
            "Close": chunk.close,
            "decision": chunk.decision,
            "in_position": in_position,
            "value": value,
            "trades": trades,
            "bar_number": start.bars_before + 1 + np.arange(size),
            "portfolio_value": shown,
            "previous": np.append(cents(np.float64(start.value_before)), shown[:-1]),
            "peak": peak,
        }
    )


def replay(
    signals: DataFrame,
    grid: BarGrid,
    rules: TradeRules = TradeRules(),
    initial: DataFrame | None = None,
    ended: bool = True,
) -> DataFrame:
    """Portfolio value of every bar and the trades closed on it, for all tickers.

    Enter on BUY when flat. Leave after `holding_period` bars, or on HOLD once
    `minimum_hold` bars have passed; a bar that closes a position may open the
    next. What is open on a ticker's last bar is closed there, free of commission,
    unless the data has not `ended`. `initial` holds `end_states` to go on from.
    """
    bars = _chunked(signals, grid)
    starts = chunk_starts(chunk_outcomes(bars, rules), rules, initial)
    if not ended:
        starts = starts.withColumn("is_last", F.lit(False))

    def run(pdf: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        return _replay_chunk(_Chunk(pdf, rules), next(start.itertuples(index=False)))

    return (
        bars.groupBy("ticker", CHUNK)
        .cogroup(starts.groupBy("ticker", CHUNK))
        .applyInPandas(run, _REPLAY)
    )


def trades(replayed: DataFrame) -> DataFrame:
    """One row per trade."""
    return replayed.select("ticker", F.inline("trades"))


def equity_curve(replayed: DataFrame) -> DataFrame:
    """One row per bar: rounded portfolio value, close, decision, position flag."""
    return replayed.select(
        "ticker",
        F.col("Date").alias("date"),
        "portfolio_value",
        F.col("Close").alias("close"),
        "decision",
        "in_position",
    )
