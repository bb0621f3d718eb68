"""Trading decisions from indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import decision_strength, dividend_tier
from tickloom.operators.chunks import CHUNK, BarGrid, in_chunk, with_lookback
from tickloom.operators.indicators import PARTIAL, IndicatorSpec, indicators
from tickloom.sources.tables import join_dimension


def add_decision(df: DataFrame, rsi: str = "rsi_14") -> DataFrame:
    """First rule that holds decides; unknown comparisons fall through to HOLD."""
    rules = [
        ("BUY", F.col("golden_cross")),
        ("SELL", F.col("dead_cross")),
        ("OVERSOLD", F.col(rsi) < 30),
        ("OVERBOUGHT", F.col(rsi) > 70),
        ("BUY_BB", F.col("Close") < F.col("bb_lower")),
        ("SELL_BB", F.col("Close") > F.col("bb_upper")),
    ]
    first = F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules], F.lit("HOLD"))
    return df.withColumn("decision", first).withColumn(
        "decision_strength", decision_strength(F.col("decision"))
    )


def add_row_tier(df: DataFrame) -> DataFrame:
    """Dividend tier of each row's own yield."""
    return df.withColumn("dividend_category", dividend_tier(F.col("dividend_yield")))


def add_latest_tier(df: DataFrame) -> DataFrame:
    """Dividend tier of the ticker's last bar, on all of its bars."""
    last = df.groupBy("ticker").agg(
        dividend_tier(F.max_by("dividend_yield", "Date")).alias("dividend_category")
    )
    return join_dimension(df, last, "ticker")


def evaluate(bars: DataFrame, grid: BarGrid, spec: IndicatorSpec = PARTIAL) -> DataFrame:
    """Bars with indicators, decision, strength and, given a yield, dividend tier."""
    df = add_decision(indicators(bars, grid, spec), f"rsi_{spec.rsi}")
    return add_row_tier(df) if "dividend_yield" in bars.columns else df


def cross_buys(df: DataFrame, grid: BarGrid, fast: str = "sma_25", slow: str = "sma_75") -> DataFrame:
    """`decision` = BUY where one given average crosses above the other, else HOLD."""
    w = in_chunk()
    above = F.col(fast) > F.col(slow)
    below = F.lag(fast, 1).over(w) <= F.lag(slow, 1).over(w)
    return (
        with_lookback(df, grid, 1)
        .withColumn("decision", F.when(above & below, "BUY").otherwise("HOLD"))
        .filter("is_core")
        .drop(CHUNK, "is_core")
    )


def with_signal_defaults(df: DataFrame, grid: BarGrid) -> DataFrame:
    """Make sure `decision` and `confidence` exist.

    A missing decision comes from the 25/75 cross if those averages exist and is
    HOLD otherwise; a missing confidence is 0.5.
    """
    if "decision" not in df.columns:
        if {"sma_25", "sma_75"} <= set(df.columns):
            df = cross_buys(df, grid)
        else:
            df = df.withColumn("decision", F.lit("HOLD"))
    if "confidence" not in df.columns:
        df = df.withColumn("confidence", F.lit(0.5))
    return df.withColumns(
        {
            "decision": F.coalesce("decision", F.lit("HOLD")),
            "confidence": F.coalesce("confidence", F.lit(0.5)),
        }
    )
