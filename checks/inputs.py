"""Price bars, fundamentals and signals derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.columns import hour_of
from tickloom.operators.chunks import BarGrid, in_chunk, with_lookback
from tickloom.sources.bars import build_bars

# Chunks far smaller than the default, so that the check covers their borders.
HOURS = BarGrid(3_600, chunk_bars=250)
DAYS = BarGrid(86_400, chunk_bars=1_000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return build_bars(
        events,
        ticker=F.col("event_type"),
        date=hour_of(F.col("ts")),
        price=F.col("value"),
        order=F.col("ts"),
        volume=F.count("*"),
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker per brand; `dividend_yield` is the discount of the bar's last line."""
    lines = table(spark, sf_dir, "lineitem")
    brands = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return build_bars(
        lines.join(brands, F.col("l_partkey") == F.col("p_partkey")),
        ticker=F.col("p_brand"),
        date=F.col("l_shipdate"),
        price=F.col("l_extendedprice"),
        order=order,
        volume=F.sum("l_quantity"),
        extra=[F.max_by("l_discount", order).alias("dividend_yield")],
    )


def damped_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly closes lifted by 3000, for everything that compounds returns."""
    close = F.round(3000 + F.col("Close"), 2)
    return hourly_bars(spark, sf_dir).select("ticker", "Date", close.alias("Close"))


def dip_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BUY where the close fell, else HOLD."""
    fell = F.col("Close") < F.lag("Close", 1).over(in_chunk())
    return (
        with_lookback(damped_bars(spark, sf_dir), HOURS, 1)
        .withColumn("decision", F.when(fell, "BUY").otherwise("HOLD"))
        .filter("is_core")
        .select("ticker", "Date", "Close", "decision")
    )


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.split_part(F.col("ticker"), F.lit("#"), F.lit(2)).cast("int")

    def unless(divisor: int, value):
        return F.when(number % divisor != 0, value)

    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("ticker"))
        .agg(
            F.min("p_type").alias("sector"),
            F.avg("p_size").alias("size"),
            F.avg("p_retailprice").alias("price"),
            F.sum("p_retailprice").alias("total"),
        )
        .select(
            "ticker",
            F.col("ticker").alias("company_name"),
            "sector",
            unless(5, F.round("size", 4)).alias("per"),
            unless(7, F.round(F.col("price") / 1000, 4)).alias("pbr"),
            unless(3, F.round(F.col("size") / 100, 4)).alias("roe"),
            F.round(F.col("total") * 100).cast("bigint").alias("market_cap"),
            ((number * 7) % 101).cast("double").alias("fundamental_score"),
        )
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, score and predicted class of each labelled document."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    sizes = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    score = F.least("n_chars", F.lit(5000)) / 5000.0
    return labels.join(sizes, "doc_id").select(
        "doc_id", "label", score.alias("score"), (score >= 0.2).cast("int").alias("prediction")
    )
