"""Reading tables and files, universes, periods and dimension joins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Catalog table, or the Parquet files at `path` where there is no such table."""
    if path is None or spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def read_first(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """First of `paths` that exists; CSV by its suffix, Parquet otherwise."""
    for path in paths:
        try:
            if path.endswith(".csv"):
                reader = spark.read if schema is None else spark.read.schema(schema)
                return reader.csv(path, header=True)
            return spark.read.parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """Small table of literal rows, for dimensions such as a ticker list."""
    return spark.createDataFrame(list(rows), schema)


def trailing_period(bars: DataFrame, period: str, end=None) -> DataFrame:
    """Bars of the last `period`, e.g. `730 days` or `2 years`.

    The period ends at `end`, or at the newest bar of the table so that a rerun
    over the same table gives the same rows.
    """
    newest = F.lit(end) if end is not None else bars.agg(F.max("Date")).scalar()
    return bars.filter(F.col("Date") >= newest - F.expr(f"INTERVAL {period}"))


def universe(bars: DataFrame, tickers: Sequence[str] | DataFrame) -> DataFrame:
    """Bars of the listed tickers only."""
    if isinstance(tickers, DataFrame):
        return bars.join(tickers.select("ticker"), "ticker", "left_semi")
    return bars.filter(F.col("ticker").isin(list(tickers)))


def for_ticker(df: DataFrame, ticker: str) -> DataFrame:
    """Rows of one ticker; none if it is unknown."""
    return df.filter(F.col("ticker") == ticker)


def missing_tickers(wanted: DataFrame, bars: DataFrame) -> DataFrame:
    """Tickers of the universe for which there is no bar at all."""
    return wanted.select("ticker").distinct().join(bars.select("ticker"), "ticker", "left_anti")


def join_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "left"
) -> DataFrame:
    """Join one row per key onto a large table.

    The plan is left to adaptive execution: it broadcasts a side that proves small
    by its size in bytes, and otherwise splits hot keys of the shuffle join.
    """
    return facts.join(dimension, key, how)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; a column some frame lacks is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes NULL, which the operators expect."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: F.nanvl(name, F.lit(None)) for name in floats})


def with_fundamental_defaults(bars: DataFrame) -> DataFrame:
    """Absent yield, capitalisation and P/E become 0, sector Unknown, name the ticker."""
    defaults = {
        "dividend_yield": F.lit(0.0),
        "market_cap": F.lit(0.0),
        "pe_ratio": F.lit(0.0),
        "sector": F.lit("Unknown"),
        "company_name": F.col("ticker"),
    }
    return bars.withColumns(
        {
            name: F.coalesce(F.col(name), value) if name in bars.columns else value
            for name, value in defaults.items()
        }
    )


def describe_tickers(df: DataFrame, tickers: DataFrame) -> DataFrame:
    """Name and sector from a ticker list; the ticker itself and Unknown otherwise."""
    known = tickers.select(
        "ticker", F.col("name").alias("company_name"), "sector"
    )
    return join_dimension(df.drop("company_name", "sector"), known, "ticker").withColumns(
        {
            "company_name": F.coalesce("company_name", "ticker"),
            "sector": F.coalesce("sector", F.lit("Unknown")),
        }
    )
