"""Positions over a stream of signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.chunks import BarGrid
from tickloom.operators.positions import TradeRules, end_states, equity_curve, replay, trades
from tickloom.session import use_checkpoints


def position_stream(
    spark: SparkSession,
    signals: DataFrame,
    folder: str,
    grid: BarGrid,
    rules: TradeRules = TradeRules(),
) -> StreamingQuery:
    """Trades and equity of a stream of signals, batch by batch, until none waits.

    Each batch goes on from the stored state of its tickers. A closed trade stays
    closed, so a ticker's bars must come in order of date. Open positions stay
    open at the end of a batch.
    """

    use_checkpoints(spark)

    def write(batch: DataFrame, number: int) -> None:
        initial = spark.read.parquet(f"{folder}/states/batch={number - 1}") if number else None
        batch = batch.persist()
        ends = end_states(batch, grid, rules, initial)
        if initial is not None:
            ends = ends.unionByName(initial.join(ends.select("ticker"), "ticker", "left_anti"))
        replayed = replay(batch, grid, rules, initial, ended=False).checkpoint()
        trades(replayed).write.mode("overwrite").parquet(f"{folder}/trades/batch={number}")
        equity_curve(replayed).write.mode("overwrite").parquet(f"{folder}/equity/batch={number}")
        ends.write.mode("overwrite").parquet(f"{folder}/states/batch={number}")
        batch.unpersist()

    return (
        signals.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
