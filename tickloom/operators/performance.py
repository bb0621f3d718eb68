"""Drawdowns, trade statistics and the metrics row of a backtest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import day_text, ratio, steady_round
from tickloom.operators.chunks import CHUNK, BarGrid, carried, in_chunk
from tickloom.operators.positions import TradeRules

TRADING_DAYS = 252


def _with_drawdown(replayed: DataFrame) -> DataFrame:
    below = F.col("portfolio_value") - F.col("peak")
    change = ratio(F.col("portfolio_value"), F.nanvl("previous", F.lit(None))) - 1
    df = replayed.withColumns({"drawdown": ratio(below, F.col("peak")), "bar_return": change})
    return df.withColumn("at_peak", F.when(F.col("drawdown") >= 0, F.col("bar_number")))


def drawdowns(replayed: DataFrame) -> DataFrame:
    """One row per bar: value, peak, drawdown and bars since the peak."""
    df = carried(
        _with_drawdown(replayed),
        {"_last_peak": F.max("at_peak")},
        {"_peak_bar_before": F.max("_last_peak")},
    )
    up_to_here = in_chunk().rowsBetween(Window.unboundedPreceding, 0)
    last_peak = F.greatest(F.max("at_peak").over(up_to_here), F.col("_peak_bar_before"))
    return df.select(
        "ticker",
        F.col("Date").alias("date"),
        "portfolio_value",
        "peak",
        "drawdown",
        (F.col("bar_number") - last_peak).alias("drawdown_run"),
    )


def pooled_deviation(count: str, mean: str, spread: str) -> Column:
    """Sample deviation of all rows, from count, mean and squared spread of its parts."""
    n, m = F.col(count).cast("double"), F.col(mean)
    rows = F.sum(n)
    between = F.sum(n * m * m) - ratio(F.sum(n * m) * F.sum(n * m), rows)
    squares = F.sum(spread) + F.greatest(between, F.lit(0.0))
    return F.when(rows > 1, F.sqrt(ratio(squares, rows - 1)))


def pooled_mean(count: str, mean: str) -> Column:
    n = F.col(count).cast("double")
    return ratio(F.sum(n * F.col(mean)), F.sum(n))


def return_moments(returns: str) -> list[Column]:
    """`n`, `mean` and `spread` of a part, for the pooled figures above."""
    return [
        F.count(returns).alias("n"),
        F.avg(returns).alias("mean"),
        (F.var_pop(returns) * F.count(returns)).alias("spread"),
    ]


def backtest_metrics(replayed: DataFrame, rules: TradeRules = TradeRules()) -> DataFrame:
    """One row of rounded metrics per ticker.

    Trades ride along as arrays on the bars that close them, and each chunk is
    reduced to one row before chunks are combined, so the replay runs once.
    """
    closed = F.coalesce("trades", F.array())

    def total(value) -> Column:
        return F.sum(F.aggregate(closed, F.lit(0.0), lambda acc, t: acc + value(t)))

    def number(keep) -> Column:
        return F.sum(F.size(F.filter(closed, keep)))

    won, lost = (lambda t: t["pnl_pct"] > 0), (lambda t: t["pnl_pct"] <= 0)
    # Longest run below the peak that starts inside the chunk.
    since = in_chunk().rowsBetween(Window.unboundedPreceding, 0)
    df = _with_drawdown(replayed).withColumn(
        "run", F.col("bar_number") - F.max("at_peak").over(since)
    )
    chunks = df.groupBy("ticker", CHUNK).agg(
        *return_moments("bar_return"),
        F.min("Date").alias("first"),
        F.max("Date").alias("last"),
        F.count("*").alias("bars"),
        F.max_by("value", "Date").alias("final"),
        F.min("drawdown").alias("drawdown"),
        F.max("run").alias("run"),
        F.min("at_peak").alias("first_peak"),
        F.max("at_peak").alias("last_peak"),
        F.max("bar_number").alias("last_bar"),
        F.sum(F.size(closed)).alias("total"),
        number(won).alias("wins"),
        number(lost).alias("losses"),
        total(lambda t: F.when(won(t), t["pnl_pct"]).otherwise(0.0)).alias("gained"),
        total(lambda t: F.when(lost(t), t["pnl_pct"]).otherwise(0.0)).alias("given"),
        total(lambda t: t["holding_days"].cast("double")).alias("held"),
    )
    # Runs that come in from earlier chunks.
    earlier = (
        Window.partitionBy("ticker").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    open_since = F.max("last_peak").over(earlier)
    run_in = F.coalesce(F.col("first_peak") - 1, F.col("last_bar")) - open_since
    sums = (
        chunks.withColumn("run_in", run_in)
        .groupBy("ticker")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.sum("bars").alias("bars"),
            F.max_by("final", "last").alias("final"),
            F.sum("n").alias("returns"),
            pooled_mean("n", "mean").alias("mean"),
            pooled_deviation("n", "mean", "spread").alias("deviation"),
            (F.abs(F.min("drawdown")) * 100).alias("max_drawdown"),
            F.greatest(F.max("run"), F.max("run_in"), F.lit(0)).alias("longest_run"),
            *[
                F.sum(name).alias(name)
                for name in ("total", "wins", "losses", "gained", "given", "held")
            ],
        )
    )
    sharpe = F.when(
        (F.col("returns") > 1) & (F.col("deviation") > 0),
        F.col("mean") / F.col("deviation") * F.sqrt(F.lit(float(TRADING_DAYS))),
    ).otherwise(0.0)
    initial = F.lit(rules.initial_capital)
    years = F.greatest(F.col("bars") / float(TRADING_DAYS), F.lit(0.01))
    growth = F.col("final") / initial
    lost_total = F.when(F.col("losses") > 0, F.abs("given")).otherwise(0.001)

    def mean(whole: str, count: str) -> Column:
        return F.coalesce(ratio(F.col(whole), F.col(count).cast("double")), F.lit(0.0))

    return sums.select(
        "ticker",
        day_text(F.col("first")).alias("start_date"),
        day_text(F.col("last")).alias("end_date"),
        initial.alias("initial_capital"),
        steady_round(F.col("final")).alias("final_capital"),
        steady_round((growth - 1) * 100).alias("total_return_pct"),
        steady_round((F.pow(growth, 1 / years) - 1) * 100).alias("annualized_return_pct"),
        steady_round(sharpe, 3).alias("sharpe_ratio"),
        steady_round(F.col("max_drawdown")).alias("max_drawdown_pct"),
        F.col("longest_run").cast("bigint").alias("max_drawdown_duration_days"),
        F.col("total").alias("total_trades"),
        F.col("wins").alias("winning_trades"),
        F.col("losses").alias("losing_trades"),
        steady_round(
            F.col("wins") * 100.0 / F.greatest(F.col("total"), F.lit(1)), 1
        ).alias("win_rate_pct"),
        steady_round(mean("gained", "wins")).alias("avg_win_pct"),
        steady_round(mean("given", "losses")).alias("avg_loss_pct"),
        steady_round(ratio(F.col("gained"), lost_total)).alias("profit_factor"),
        steady_round(mean("held", "total"), 1).alias("avg_holding_days"),
    )


def result_document(metrics: DataFrame, trades: DataFrame, equity: DataFrame, grid: BarGrid) -> DataFrame:
    """Backtest results as JSON documents with their trades and daily values.

    A document covers one (ticker, chunk), so that its size stays bounded; a
    ticker shorter than a chunk yields a single document.
    """
    kept = ["entry_date", "entry_price", "exit_date", "exit_price", "holding_days", "pnl", "pnl_pct", "exit_reason"]
    closed = (
        trades.withColumn(CHUNK, grid.chunk("exit_date"))
        .groupBy("ticker", CHUNK)
        .agg(F.array_sort(F.collect_list(F.struct("exit_date", "entry_date", *[c for c in kept if c not in ("exit_date", "entry_date")]))).alias("trades"))
    )
    daily = (
        equity.withColumn(CHUNK, grid.chunk("date"))
        .groupBy("ticker", CHUNK)
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("date", "portfolio_value", "close", "decision", "in_position")
                )
            ).alias("daily_portfolio_values")
        )
    )
    parts = daily.join(closed, ["ticker", CHUNK], "left").withColumn(
        "trades", F.coalesce("trades", F.array())
    )
    whole = parts.join(metrics, "ticker")
    body = F.struct(*metrics.columns, "trades", "daily_portfolio_values")
    return whole.select("ticker", F.col(CHUNK).alias("part"), F.to_json(body).alias("value"))
