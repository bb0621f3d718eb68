from __future__ import annotations

import random

import pytest
from conftest import by_date, day
from pyspark.sql import functions as F

from tickloom.operators.chunks import DAILY, BarGrid
from tickloom.operators.performance import backtest_metrics, drawdowns, result_document
from tickloom.operators.positions import TradeRules, equity_curve, replay, trades

BARS = "ticker string, Date timestamp_ntz, Close double, decision string"


def bars_of(spark, **tickers):
    """Tickers as lists of (close, decision letter): B, H, or anything else."""
    names = {"B": "BUY", "H": "HOLD", "S": "SELL"}
    rows = [
        (ticker, day(i), float(close), names[letter])
        for ticker, bars in tickers.items()
        for i, (close, letter) in enumerate(bars)
    ]
    return spark.createDataFrame(rows, BARS)


def walk(bars, rules):
    """Bar-by-bar reading of the rules, for comparison."""
    capital, held, entry, out, values = rules.initial_capital, None, None, [], []
    for i, (close, letter) in enumerate(bars):
        if held is not None:
            held += 1
            if held >= rules.holding_period or (letter == "H" and held >= rules.minimum_hold):
                reason = "holding_period" if held >= rules.holding_period else "decision_change"
                out.append((entry[0], i, held, reason))
                capital = capital * (close / entry[1]) - capital * rules.commission_rate
                held = None
        if held is None and letter == "B":
            held, entry = 0, (i, close)
        values.append(round(capital if held is None else capital * (close / entry[1]), 2))
    if held is not None:
        out.append((entry[0], len(bars) - 1, held, "end_of_data"))
    return out, values


def seen(df, ticker):
    rows = trades(df).filter(F.col("ticker") == ticker).collect()
    index = lambda date: (date - day(0)).days
    return sorted(
        (index(r.entry_date), index(r.exit_date), r.holding_days, r.exit_reason) for r in rows
    )


@pytest.mark.parametrize("letters", ["BBBBBBB", "BHHHS", "SSB", "B", "HHBSSSHB"])
@pytest.mark.parametrize("chunk_bars", [1, 2, 100])
def test_small_series(spark, letters, chunk_bars):
    rules = TradeRules(holding_period=4)
    bars = [(100 + 7 * i % 13, letter) for i, letter in enumerate(letters)]
    df = replay(bars_of(spark, T=bars), BarGrid(86_400, chunk_bars), rules)
    expected, values = walk(bars, rules)
    assert seen(df, "T") == sorted(expected)
    got = sorted(equity_curve(df).collect(), key=lambda r: r.date)
    assert [r.portfolio_value for r in got] == pytest.approx(values, abs=0.011)


def test_random_series_in_chunks(spark):
    random.seed(5)
    tickers = {
        f"T{k}": [(random.uniform(50, 150), random.choice(mix)) for _ in range(120)]
        for k, mix in enumerate(["BH", "BHHHH", "BBBBB", "BS", "BSSSSSSSSSSSH"])
    }
    for holding in (1, 5, 20):
        rules = TradeRules(holding_period=holding)
        for chunk_bars in (23,):
            df = replay(bars_of(spark, **tickers), BarGrid(86_400, chunk_bars), rules)
            for ticker, bars in tickers.items():
                assert seen(df, ticker) == sorted(walk(bars, rules)[0])


def test_metrics_are_the_same_for_any_chunk_size(spark):
    random.seed(6)
    price, bars = 100.0, []
    for _ in range(150):
        price *= random.uniform(0.97, 1.03)
        bars.append((round(price, 2), random.choice("BHS")))
    rules = TradeRules(holding_period=6)
    df = bars_of(spark, T=bars, FLAT=[(10, "H")] * 30)
    runs = [replay(df, BarGrid(86_400, n), rules) for n in (9, 40, 1000)]
    metrics = [sorted(backtest_metrics(r, rules).collect()) for r in runs]
    assert metrics[0] == metrics[1] == metrics[2]
    down = [sorted(drawdowns(r).collect()) for r in runs]
    assert down[0] == down[1] == down[2]
    longest = max(r.drawdown_run for r in down[0] if r.ticker == "T")
    assert longest == [m for m in metrics[0] if m.ticker == "T"][0].max_drawdown_duration_days
    assert all(r.drawdown <= 0 for r in down[0])


def test_no_trades(spark):
    rules = TradeRules()
    row = backtest_metrics(replay(bars_of(spark, T=[(5, "H"), (6, "H")]), DAILY, rules), rules).first()
    assert (row.total_trades, row.win_rate_pct, row.sharpe_ratio, row.profit_factor) == (0, 0.0, 0.0, 0.0)
    assert row.final_capital == 1_000_000.0 and row.max_drawdown_pct == 0.0


def test_all_losses(spark):
    rules = TradeRules()
    bars = [(100, "B"), (90, "S"), (80, "S"), (70, "H"), (70, "H")]
    row = backtest_metrics(replay(bars_of(spark, T=bars), DAILY, rules), rules).first()
    assert (row.total_trades, row.losing_trades, row.avg_loss_pct) == (1, 1, -30.0)
    assert row.final_capital == 699_000.0 and row.profit_factor == 0.0


def test_entry_on_last_bar_is_closed_free_of_commission(spark):
    df = replay(bars_of(spark, T=[(100, "H"), (100, "B")]), DAILY)
    trade = trades(df).first()
    assert (trade.holding_days, trade.exit_reason, trade.pnl) == (0, "end_of_data", 0.0)
    assert by_date(df)[1].value == 1_000_000.0


def test_exit_and_entry_on_one_bar(spark):
    bars = [(100, "B"), (101, "S"), (102, "B"), (103, "B"), (104, "H")]
    df = replay(bars_of(spark, T=bars), DAILY, TradeRules(holding_period=2))
    assert seen(df, "T") == [(0, 2, 2, "holding_period"), (2, 4, 2, "holding_period")]


def test_result_document(spark):
    rules = TradeRules()
    df = replay(bars_of(spark, T=[(100, "B"), (110, "S"), (120, "S"), (130, "H")]), DAILY, rules)
    doc = result_document(backtest_metrics(df, rules), trades(df), equity_curve(df), DAILY).first()
    assert '"total_trades":1' in doc.value and '"exit_reason":"decision_change"' in doc.value


def test_stream_goes_on_from_stored_states(spark, tmp_path):
    from tickloom.streaming.positions import position_stream

    random.seed(7)
    bars = {t: [(random.uniform(50, 150), random.choice("BHS")) for _ in range(60)] for t in "AB"}
    df = bars_of(spark, **bars, C=[(10, "B"), (11, "S")])
    rules = TradeRules(holding_period=5)
    for n in range(3):
        part = df.filter(F.floor(F.datediff("Date", F.lit(day(0))) / 20) == n)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    grid = BarGrid(86_400, 15)
    position_stream(spark, stream.parquet(f"{tmp_path}/in"), f"{tmp_path}/s", grid, rules).awaitTermination()
    whole = replay(df, grid, rules)
    closed = sorted(
        map(str, trades(whole).filter("exit_reason <> 'end_of_data'").drop("pnl").collect())
    )
    got = spark.read.parquet(f"{tmp_path}/s/trades").drop("batch", "pnl")
    assert sorted(map(str, got.collect())) == closed
    equity = spark.read.parquet(f"{tmp_path}/s/equity").drop("batch")
    assert sorted(map(str, equity.collect())) == sorted(map(str, equity_curve(whole).collect()))
    last = spark.read.parquet(f"{tmp_path}/s/states/batch=2")
    assert {r.ticker: r.bars_before for r in last.collect()} == {"A": 60, "B": 60, "C": 2}
