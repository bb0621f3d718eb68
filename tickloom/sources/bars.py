"""Building price bars from raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build_bars(
    rows: DataFrame,
    ticker: Column,
    date: Column,
    price: Column,
    order: Column,
    volume: Column,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One bar per (ticker, date): first, highest, lowest and last price, and volume.

    `order` ranks the rows of a bar and must be unique within it. All aggregates
    combine on the map side, so a ticker with many rows costs no extra shuffle.
    """
    return rows.groupBy(ticker.alias("ticker"), date.alias("Date")).agg(
        F.min_by(price, order).alias("Open"),
        F.max(price).alias("High"),
        F.min(price).alias("Low"),
        F.max_by(price, order).alias("Close"),
        volume.cast("bigint").alias("Volume"),
        *extra,
    )


def first_per_bar(rows: DataFrame, order: Column) -> DataFrame:
    """Keep the first row, by `order`, of each (ticker, Date)."""
    values = [c for c in rows.columns if c not in ("ticker", "Date")]
    return (
        rows.groupBy("ticker", "Date")
        .agg(F.min_by(F.struct(*values), order).alias("_first"))
        .select("ticker", "Date", "_first.*")
    )
