"""Counts and quality reports over bar tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import exact, exact_ratio, steady_round


def exact_mean(price: Column) -> Column:
    """Mean from a decimal sum."""
    return exact_ratio(F.sum(exact(price)), F.count(price))


def quality_report(bars: DataFrame) -> DataFrame:
    """Rows, dates, mean close and highest yield per ticker, name and sector."""
    return (
        bars.groupBy("ticker", "company_name", "sector")
        .agg(
            F.count("*").alias("row_count"),
            F.min("Date").alias("first_date"),
            F.max("Date").alias("last_date"),
            steady_round(exact_mean(F.col("Close"))).alias("avg_close"),
            steady_round(F.max("dividend_yield") * 100).alias("div_yield_pct"),
        )
        .orderBy("ticker")
    )


def export_summary(df: DataFrame) -> DataFrame:
    """One row: rows, tickers and period of a table."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.countDistinct("ticker").alias("ticker_count"),
        F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"),
    )


def per_ticker_span(bars: DataFrame) -> DataFrame:
    """Rows, first and last date per ticker."""
    return bars.groupBy("ticker").agg(
        F.count("*").alias("rows"),
        F.min("Date").alias("start_date"),
        F.max("Date").alias("end_date"),
    )


def distribution(df: DataFrame, column: str = "decision") -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)
