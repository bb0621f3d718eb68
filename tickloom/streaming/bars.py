"""Streams of bars: building them, dropping repeats, evaluating what is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tickloom.operators.chunks import BarGrid, recent
from tickloom.operators.decisions import evaluate
from tickloom.operators.indicators import PARTIAL, IndicatorSpec
from tickloom.sources.bars import first_per_bar


def stream_bars(
    rows: DataFrame, ticker: Column, ts: Column, price: Column, width: str = "1 hour", late: str = "1 hour"
) -> DataFrame:
    """Bars per ticker and event-time window, emitted once no row of theirs can come.

    Windows need instants, so zone-free times are read as UTC and given back
    zone-free.
    """
    timed = rows.select(
        ticker.alias("ticker"), ts.cast("timestamp").alias("_ts"), price.alias("_price")
    )
    bars = (
        timed.withWatermark("_ts", late)
        .groupBy("ticker", F.window("_ts", width).alias("_w"))
        .agg(
            F.min_by("_price", "_ts").alias("Open"),
            F.max("_price").alias("High"),
            F.min("_price").alias("Low"),
            F.max_by("_price", "_ts").alias("Close"),
            F.count("*").alias("Volume"),
        )
    )
    date = F.col("_w.start").cast("timestamp_ntz").alias("Date")
    return bars.select("ticker", date, "Open", "High", "Low", "Close", "Volume")


def with_open_bars(
    emitted: DataFrame, rows: DataFrame, ticker: Column, ts: Column, price: Column, width: str = "1 hour"
) -> DataFrame:
    """The bars a finished stream has emitted, and those the watermark still kept open.

    Open windows are younger than the last emitted one, so only the newest of the
    stored `rows` are read for them, as a batch.
    """
    last = emitted.agg(F.max("Date")).scalar()
    newest = rows.filter(last.isNull() | (ts.cast("timestamp_ntz") >= last))
    built = stream_bars(newest, ticker, ts, price, width)
    still_open = built.join(emitted.select("ticker", "Date"), ["ticker", "Date"], "left_anti")
    return emitted.unionByName(still_open)


def first_bars(bars: DataFrame, late: str = "2 days") -> DataFrame:
    """Drop repeats of a (ticker, Date) across messages, within a watermark."""
    return (
        bars.withColumn("_at", F.col("Date").cast("timestamp"))
        .withWatermark("_at", late)
        .dropDuplicatesWithinWatermark(["ticker", "Date"])
        .drop("_at")
    )


def first_in_time(bars: DataFrame, order: Column, late: str = "2 days") -> DataFrame:
    """Of the bars of each (ticker, Date), the one that is first by `order`, whatever comes first.

    A bar is given out once the newest date has passed it by `late`, as until then an
    earlier one may come; repeats that are later than that are dropped. The state holds one row per
    open (ticker, Date).
    """
    values = [c for c in bars.columns if c not in ("ticker", "Date")]
    row = F.struct(*[F.col(f"`{c}`") for c in values]).alias("_row")
    return (
        bars.select("ticker", F.col("Date").cast("timestamp").alias("_at"), row, order.alias("_order"))
        .withWatermark("_at", late)
        .groupBy("ticker", "_at")
        .agg(F.min_by("_row", "_order").alias("_first"))
        .select("ticker", F.col("_at").cast("timestamp_ntz").alias("Date"), "_first.*")
        .select(*[F.col(f"`{c}`") for c in bars.columns])
    )


def evaluate_batch(
    tails: DataFrame,
    history: Callable[[], DataFrame],
    batch: DataFrame,
    grid: BarGrid,
    spec: IndicatorSpec = PARTIAL,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new bars, evaluated bars, new tails) of a micro-batch.

    `tails` holds the last `spec.lookback` stored bars of every ticker. Bars in
    order need nothing else. Only where a bar is no newer than what its ticker
    has, `history` is read: bars stored already are dropped, and from a ticker's
    earliest late bar on, every bar is evaluated again.
    """
    newest = tails.groupBy("ticker").agg(F.max("Date").alias("_newest"))
    dated = batch.join(newest, "ticker", "left")
    is_late = F.coalesce(F.col("Date") <= F.col("_newest"), F.lit(False))
    late = dated.filter(is_late).drop("_newest")
    due, not_due = F.lit(True).alias("is_due"), F.lit(False).alias("is_due")
    if late.isEmpty():
        new = batch
        around = tails.select("*", not_due).unionByName(new.select("*", due))
    else:
        stored = history()
        seen = late.join(stored.select("ticker", "Date"), ["ticker", "Date"], "left_semi")
        new = batch.join(seen.select("ticker", "Date"), ["ticker", "Date"], "left_anti")
        since = new.groupBy("ticker").agg(F.min("Date").alias("_since"))
        touched = stored.join(since, "ticker")
        older = recent(touched.filter("Date < _since"), spec.lookback, grid).drop("_since")
        later = touched.filter("Date >= _since").drop("_since")
        others = tails.join(since, "ticker", "left_anti")
        around = others.unionByName(older).select("*", not_due)
        around = around.unionByName(later.select("*", due)).unionByName(new.select("*", due))
    # Tickers without a due bar only pass on their tails.
    active = around.filter("is_due").select("ticker").distinct()
    df = evaluate(around.join(active, "ticker", "left_semi"), grid, spec)
    evaluated = df.filter("is_due").drop("is_due")
    return new, evaluated, recent(around.drop("is_due"), spec.lookback, grid)


def evaluate_stream(
    spark: SparkSession,
    bars: DataFrame,
    folder: str,
    grid: BarGrid,
    spec: IndicatorSpec = PARTIAL,
) -> StreamingQuery:
    """Store and evaluate the bars of a stream, batch by batch, until none waits.

    The stored bars and tails are the state, so nothing is kept in memory between
    batches and a batch that is run again after a failure replaces its own output.
    """

    def write(batch: DataFrame, number: int) -> None:
        def history() -> DataFrame:
            stored = spark.read.schema(with_batch).parquet(f"{folder}/bars")
            return stored.filter(F.col("batch") < number).drop("batch")

        with_batch = StructType(batch.schema.fields + [StructField("batch", LongType())])
        if number:
            before = spark.read.schema(batch.schema).parquet(f"{folder}/tails/batch={number - 1}")
        else:
            before = batch.limit(0)
        # of repeated bars the smallest by value, so that a rerun keeps the same one
        once = first_per_bar(batch, F.struct(*batch.drop("ticker", "Date").columns)).persist()
        new, evaluated, tails = evaluate_batch(before, history, once, grid, spec)
        evaluated.write.mode("overwrite").parquet(f"{folder}/evaluated/batch={number}")
        tails.write.mode("overwrite").parquet(f"{folder}/tails/batch={number}")
        new.write.mode("overwrite").parquet(f"{folder}/bars/batch={number}")
        once.unpersist()

    return (
        bars.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )


def current_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The last evaluation of every bar of an evaluated stream."""
    rows = spark.read.parquet(f"{folder}/evaluated")
    values = [c for c in rows.columns if c not in ("ticker", "Date", "batch")]
    return (
        rows.groupBy("ticker", "Date")
        .agg(F.max_by(F.struct(*values), "batch").alias("_last"))
        .select("ticker", "Date", "_last.*")
    )
