"""Latest rows per ticker, previews and the serving view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import exact
from tickloom.operators.chunks import BarGrid, recent
from tickloom.operators.decisions import add_decision, add_row_tier
from tickloom.operators.indicators import PARTIAL, IndicatorSpec, add_indicators


def latest(df: DataFrame) -> DataFrame:
    """The newest row of each ticker. Each task sends one row per ticker."""
    row = F.struct(*[c for c in df.columns if c != "ticker"])
    newest_row = df.groupBy("ticker").agg(F.max_by(row, "Date").alias("_row"))
    return newest_row.select("ticker", "_row.*").select(*df.columns)


def latest_evaluated(bars: DataFrame, grid: BarGrid, spec: IndicatorSpec = PARTIAL) -> DataFrame:
    """The newest bar of each ticker with indicators and decision.

    Indicators look back a fixed number of bars, so only the chunks that hold
    these are ranked, however long the history is.
    """
    w = Window.partitionBy("ticker").orderBy("Date")
    near = add_indicators(recent(bars, spec.lookback + 1, grid), spec, w)
    df = add_decision(latest(near), f"rsi_{spec.rsi}")
    return add_row_tier(df) if "dividend_yield" in bars.columns else df


def newest(df: DataFrame, rows: int = 20, *columns: str) -> DataFrame:
    """The newest rows over all tickers; ties go by ticker."""
    chosen = df.select(*columns) if columns else df
    return chosen.orderBy(F.desc("Date"), "ticker").limit(rows)


def history(df: DataFrame, ticker: str) -> DataFrame:
    """All rows of one ticker in order of date."""
    return df.filter(F.col("ticker") == ticker).orderBy("Date")


def dividend_ranking(snapshot: DataFrame) -> DataFrame:
    """Dense rank by dividend yield over a latest-per-ticker table.

    The ranked window holds one row per distinct yield, not one per ticker.
    """
    yields = snapshot.select("dividend_yield").distinct()
    ranks = yields.withColumn(
        "dividend_rank",
        F.dense_rank().over(Window.orderBy(F.desc_nulls_last("dividend_yield"))),
    )
    same = snapshot["dividend_yield"].eqNullSafe(ranks["dividend_yield"])
    return snapshot.join(ranks, same).select(snapshot["*"], ranks["dividend_rank"])


def serving_view(snapshot: DataFrame) -> DataFrame:
    """Rows for the serving table, numbered by ticker. One row per ticker goes in."""
    numbered = Window.orderBy("ticker")
    return snapshot.select(
        F.row_number().over(numbered).cast("bigint").alias("id"),
        "ticker",
        F.col("company_name").alias("companyName"),
        F.col("Date").cast("date").alias("decisionDate"),
        F.col("decision").alias("decisionType"),
        F.col("confidence").alias("confidence"),
        exact(F.col("Close")).cast("decimal(18,2)").alias("closePrice"),
        F.col("rsi_14").alias("rsi14"),
        F.col("fundamental_score").alias("fundamentalScore"),
    )
