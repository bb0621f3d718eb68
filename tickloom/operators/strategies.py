"""Vectorised strategies: positions, returns, curves and metrics.

All strategies of a grid are evaluated in one pass over the bars.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.columns import exact, flag, json_safe, ratio
from tickloom.operators.chunks import CHUNK, BarGrid, carried, in_chunk, with_lookback
from tickloom.operators.indicators import _last, relative_strength, rolling_mean
from tickloom.operators.performance import (
    TRADING_DAYS,
    pooled_deviation,
    pooled_mean,
    return_moments,
)

RSI_BARS = 14
KEYS = ("ticker", "strategy")


@dataclass(frozen=True)
class Strategy:
    """`RSI` holds below a threshold, `SMA_Cross` while fast > slow, any other always."""

    kind: str = "Hold"
    threshold: float = 50.0
    fast: int = 20
    slow: int = 50

    @property
    def label(self) -> str:
        if self.kind == "RSI":
            return f"RSI({self.threshold:g})"
        if self.kind == "SMA_Cross":
            return f"SMA_Cross({self.fast},{self.slow})"
        return self.kind

    @property
    def lookback(self) -> int:
        return {"RSI": RSI_BARS, "SMA_Cross": max(self.fast, self.slow)}.get(self.kind, 0) + 1

    def signal(self, w: WindowSpec) -> Column | None:
        """1 while the strategy wants to be in the market; None for always."""
        if self.kind == "RSI":
            rsi = relative_strength(
                _last("_gains", RSI_BARS, w), _last("_losses", RSI_BARS, w), F.lit(RSI_BARS), None
            )
            return flag((F.col("_row") >= RSI_BARS) & (rsi < self.threshold))
        if self.kind == "SMA_Cross":
            fast, slow = (rolling_mean(n, w, full=True) for n in (self.fast, self.slow))
            return flag(fast > slow)
        return None


def strategy_returns(bars: DataFrame, grid: BarGrid, strategies: Sequence[Strategy]) -> DataFrame:
    """One row per (ticker, strategy, bar) that has a return. Keeps `chunk`.

    The position of a bar is the signal of the bar before.
    """
    w = in_chunk()
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = max(s.lookback for s in strategies) + 1
    df = with_lookback(bars.select("ticker", "Date", "Close"), grid, rows)
    df = df.withColumn("_exact", exact(F.col("Close")))
    df = df.withColumn("_step", F.col("_exact") - F.lag("_exact", 1).over(w))
    nothing = exact(F.lit(0))
    up, down = F.greatest("_step", nothing), F.greatest(-F.col("_step"), nothing)
    df = df.withColumns(
        {
            "_sum": F.coalesce(F.sum("_exact").over(running), F.lit(0)),
            "_seen": F.count("_exact").over(running),
            "_gains": F.sum(up).over(running),
            "_losses": F.sum(down).over(running),
            "_row": F.row_number().over(w),
            "daily_return": ratio(F.col("Close"), F.lag("Close", 1).over(w)) - 1,
        }
    )
    signals = {f"_signal_{i}": s.signal(w) for i, s in enumerate(strategies)}
    df = df.withColumns({name: c for name, c in signals.items() if c is not None})
    positions = {
        name: F.lit(1) if c is None else F.coalesce(F.lag(name, 1).over(w), F.lit(0))
        for name, c in signals.items()
    }
    df = df.withColumns(positions).filter(F.col("is_core") & F.col("daily_return").isNotNull())
    held = F.array(
        *[
            F.struct(F.lit(s.label).alias("strategy"), F.col(name).alias("position"))
            for s, name in zip(strategies, signals)
        ]
    )
    return (
        df.select("ticker", CHUNK, "Date", "Close", "daily_return", F.inline(held))
        .withColumn("strategy_return", F.col("daily_return") * F.col("position"))
    )


def _compounded(returns: DataFrame) -> DataFrame:
    """Add growth since the start of the chunk for strategy and base."""
    up_to_here = in_chunk(*KEYS).rowsBetween(Window.unboundedPreceding, 0)
    return returns.withColumns(
        {
            "_growth": F.product(1 + F.col("strategy_return")).over(up_to_here),
            "_base": F.product(1 + F.col("daily_return")).over(up_to_here),
        }
    )


def strategy_curve(returns: DataFrame) -> DataFrame:
    """Cumulative value of strategy and base, both starting from 1."""
    df = carried(
        _compounded(returns),
        {
            "_chunk_growth": F.max_by("_growth", "Date"),
            "_chunk_base": F.max_by("_base", "Date"),
        },
        {
            "_growth_before": F.product("_chunk_growth"),
            "_base_before": F.product("_chunk_base"),
        },
        KEYS,
    )
    one = F.lit(1.0)
    return df.select(
        *KEYS,
        CHUNK,
        "Date",
        "position",
        "strategy_return",
        (F.coalesce("_growth_before", one) * F.col("_growth")).alias("cumulative"),
        (F.coalesce("_base_before", one) * F.col("_base")).alias("base_cumulative"),
    )


def reindex_forward_fill(base: DataFrame, onto: DataFrame, value: str, grid: BarGrid) -> DataFrame:
    """`value` of `base` on the dates of `onto`, carried forward over missing dates."""
    joined = onto.withColumn(CHUNK, grid.chunk()).join(
        base.select("ticker", "Date", value).withColumn(CHUNK, grid.chunk()),
        ["ticker", CHUNK, "Date"],
        "left",
    )
    df = carried(
        joined,
        {"_last": F.max_by(value, F.when(F.col(value).isNotNull(), F.col("Date")))},
        {"_before": F.last("_last", ignorenulls=True)},
    )
    up_to_here = in_chunk().rowsBetween(Window.unboundedPreceding, 0)
    filled = F.last(value, ignorenulls=True).over(up_to_here)
    return df.withColumn(value, F.coalesce(filled, "_before")).drop("_before", CHUNK)


def strategy_metrics(returns: DataFrame) -> DataFrame:
    """Sharpe, CAGR, drawdown, win rate and volatility per (ticker, strategy).

    The risk-free rate is 0, a year has 252 bars, and the starting value counts
    as a peak. Each chunk is reduced to one row first: the lowest point below an
    earlier peak needs only the chunk's lowest value, that below a peak of its
    own only the chunk itself.
    """
    up_to_here = in_chunk(*KEYS).rowsBetween(Window.unboundedPreceding, 0)
    r = F.col("strategy_return")
    df = _compounded(returns).withColumn("_peak", F.max("_growth").over(up_to_here))
    chunks = df.groupBy(*KEYS, CHUNK).agg(
        *return_moments("strategy_return"),
        F.max_by("_growth", "Date").alias("growth"),
        F.max("_growth").alias("top"),
        F.min("_growth").alias("low"),
        F.min(ratio(F.col("_growth"), F.col("_peak"))).alias("own"),
        F.count_if(r > 0).alias("up"),
        F.count_if(r != 0).alias("moved"),
    )
    earlier = (
        Window.partitionBy(*KEYS).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    one = F.lit(1.0)
    chunks = chunks.withColumn("before", F.coalesce(F.product("growth").over(earlier), one))
    chunks = chunks.withColumn(
        "peak_before",
        F.greatest(F.coalesce(F.max(F.col("before") * F.col("top")).over(earlier), one), one),
    )
    # A chunk's own peak counts only where it exceeds the earlier ones, but the
    # smaller of the two ratios is right either way.
    lowest = F.least(F.col("before") * F.col("low") / F.col("peak_before"), F.col("own"))
    year = float(TRADING_DAYS)
    sums = chunks.groupBy(*KEYS).agg(
        F.sum("n").alias("bars"),
        pooled_mean("n", "mean").alias("mean"),
        pooled_deviation("n", "mean", "spread").alias("deviation"),
        F.product("growth").alias("growth"),
        F.min(lowest).alias("lowest"),
        F.sum("up").alias("up"),
        F.sum("moved").alias("moved"),
    )
    deviation = F.col("deviation")
    return sums.select(
        *KEYS,
        json_safe(ratio(F.col("mean"), deviation) * F.sqrt(F.lit(year))).alias("sharpe_ratio"),
        json_safe((F.pow("growth", year / F.col("bars")) - 1) * 100).alias("cagr_pct"),
        json_safe((F.least(F.col("lowest"), one) - 1) * 100).alias("max_drawdown_pct"),
        json_safe(ratio(F.col("up").cast("double"), F.col("moved").cast("double")) * 100).alias("win_rate_pct"),
        json_safe(deviation * F.sqrt(F.lit(year)) * 100).alias("volatility_pct"),
    )


def evaluate_strategy(bars: DataFrame, grid: BarGrid, *strategies: Strategy) -> tuple[DataFrame, DataFrame]:
    """(metrics, curve) of the strategies over all tickers of `bars`."""
    returns = strategy_returns(bars, grid, strategies)
    return strategy_metrics(returns), strategy_curve(returns)


def chart_response(curve: DataFrame, metrics: DataFrame) -> DataFrame:
    """Metrics with three parallel arrays (dates, returns, base returns).

    One row per chunk of a curve, so that the arrays stay bounded.
    """
    points = curve.groupBy(*KEYS, CHUNK).agg(
        F.array_sort(
            F.collect_list(F.struct("Date", "cumulative", "base_cumulative"))
        ).alias("points")
    )
    return points.join(metrics, list(KEYS)).select(
        *KEYS,
        F.col(CHUNK).alias("part"),
        *[c for c in metrics.columns if c not in KEYS],
        F.transform("points", lambda p: F.date_format(p["Date"], "yyyy-MM-dd")).alias("dates"),
        F.col("points.cumulative").alias("returns"),
        F.col("points.base_cumulative").alias("base_returns"),
    )
