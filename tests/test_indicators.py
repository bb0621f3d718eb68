from __future__ import annotations

import math
import statistics

import pytest
from conftest import by_date, day
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.inputs import hourly_bars
from checks.queries import REGISTRY
from tickloom.functions.columns import steady_round
from tickloom.operators.chunks import DAILY, BarGrid, recent
from tickloom.operators.decisions import add_latest_tier, evaluate, with_signal_defaults
from tickloom.operators.indicators import (
    FULL,
    PARTIAL,
    UNGUARDED,
    IndicatorSpec,
    forward_label,
    indicators,
    moving_averages,
    price_changes,
)
from tickloom.operators.snapshot import latest, latest_evaluated

SMALL = IndicatorSpec(sma=(2, 3), cross=(2, 3), rsi=3, bands=3)


def table(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("chunk_bars", [3, 60])
@pytest.mark.parametrize("spec", [PARTIAL, FULL, UNGUARDED])
def test_chunks_do_not_change_indicators(spark, sf, chunk_bars, spec):
    bars = hourly_bars(spark, sf).filter("ticker in ('click', 'view')")
    whole = table(indicators(bars, BarGrid(3600), spec))
    assert table(indicators(bars, BarGrid(3600, chunk_bars), spec)) == whole


def test_chunks_do_not_change_labels_and_changes(spark, sf):
    bars = hourly_bars(spark, sf)
    for run in (lambda g: forward_label(bars, g), lambda g: price_changes(bars, g)):
        assert table(run(BarGrid(3600, 5))) == table(run(BarGrid(3600)))


def test_sparse_chunks_reach_far_back(spark):
    """Bars so far apart that most chunks are empty and the rest hold one bar."""
    rows = [("T", d, float(i + 1)) for i, d in enumerate([0, 1, 40, 90, 300, 301, 900])]
    bars = spark.createDataFrame(rows, "ticker string, d int, Close double").select(
        "ticker", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(d)").alias("Date"), "Close"
    )
    got = by_date(moving_averages(bars, BarGrid(86_400, 2), (3,)))
    assert [r.sma_3 for r in got] == [1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 6.0]


def test_warm_up_rules(series):
    bars = series(T=[1.0, 2.0, 4.0, 8.0])
    partial = by_date(moving_averages(bars, DAILY, (3,)))
    full = by_date(moving_averages(bars, DAILY, (3,), full=True))
    assert [r.sma_3 for r in partial] == [1.0, 1.5, 2.33, 4.67]
    assert [r.sma_3 for r in full] == [None, None, 2.33, 4.67]


def test_null_close_is_skipped_or_voids_the_window(series):
    bars = series(T=[1.0, None, 3.0, 5.0, 7.0])
    partial = by_date(moving_averages(bars, DAILY, (2,)))
    full = by_date(moving_averages(bars, DAILY, (2,), full=True))
    assert [r.sma_2 for r in partial] == [1.0, 1.0, 3.0, 4.0, 6.0]
    assert [r.sma_2 for r in full] == [None, None, None, 4.0, 6.0]


def test_ties_round_up(series):
    got = by_date(moving_averages(series(T=[1.00, 1.01]), DAILY, (2,)))
    assert got[1].sma_2 == 1.01


def test_flat_rising_and_falling_strength(series):
    bars = series(FLAT=[5.0] * 16, UP=[float(i + 1) for i in range(16)], DOWN=[float(99 - i) for i in range(16)])
    guarded = indicators(bars, DAILY, PARTIAL)
    assert {r.rsi_14 for r in by_date(guarded, "FLAT")} == {0.0}
    assert by_date(guarded, "UP")[0].rsi_14 == 0.0
    assert by_date(guarded, "UP")[15].rsi_14 == 99.9
    assert by_date(guarded, "DOWN")[15].rsi_14 == 0.0
    bare = indicators(bars, DAILY, UNGUARDED)
    assert by_date(bare, "FLAT")[15].rsi_14 is None
    assert [r.rsi_14 for r in by_date(bare, "UP")][12:14] == [None, 100.0]


def test_first_bar_has_no_bands_and_is_oversold(series):
    first, second = by_date(evaluate(series(T=[10.0, 10.0]), DAILY))
    assert first.bb_upper is None and second.bb_upper == 10.0
    assert first.decision == "OVERSOLD" and first.decision_strength == 7
    assert first.daily_return_pct is None


def test_zero_previous_close_gives_null_not_error(series):
    got = by_date(indicators(series(T=[0.0, 3.0]), DAILY, PARTIAL))
    assert got[1].daily_return_pct is None


def test_crosses_fire_once(series):
    # Means of 2: 9, 8.5, 7.5, 8, 10.5, 8.5, 4; of 3: 9, 8.5, 8, 8, 9.33, 8.67, 6.67.
    got = by_date(indicators(series(T=[9.0, 8.0, 7.0, 9.0, 12.0, 5.0, 3.0]), DAILY, SMALL))
    assert [i for i, r in enumerate(got) if r.golden_cross] == [4]
    assert [i for i, r in enumerate(got) if r.dead_cross] == [2, 5]


def test_latest_needs_only_the_last_bars(spark, sf):
    bars = hourly_bars(spark, sf)
    assert table(latest_evaluated(bars, BarGrid(3600))) == table(latest(evaluate(bars, BarGrid(3600))))


def test_tier_of_last_bar(spark, series):
    bars = series(T=[1.0, 2.0], U=[1.0]).withColumn(
        "dividend_yield", F.when(F.col("Volume") == 101, 0.05).otherwise(0.01)
    )
    assert {r.dividend_category for r in by_date(add_latest_tier(bars))} == {"高配当(4%+)"}
    assert {r.dividend_category for r in by_date(add_latest_tier(bars), "U")} == {"低配当(<2%)"}


def test_signal_defaults(series):
    plain = by_date(with_signal_defaults(series(T=[1.0]), DAILY))[0]
    assert (plain.decision, plain.confidence) == ("HOLD", 0.5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 100_000).map(lambda c: c / 100), min_size=1, max_size=40))
def test_indicator_bounds(series, closes):
    rows = by_date(indicators(series(T=closes), BarGrid(86_400, 7), PARTIAL))
    assert len(rows) == len(closes)
    for i, r in enumerate(rows):
        assert 0 <= r.rsi_14 <= 100
        window = closes[max(0, i - 19) : i + 1]
        assert math.isclose(r.sma_20, statistics.fmean(window), abs_tol=0.00501)
        if r.bb_upper is not None:
            assert r.bb_lower <= r.sma_20 <= r.bb_upper


def test_one_sort_and_one_full_shuffle_for_the_chain(spark, sf, tmp_path):
    bars = hourly_bars(spark, sf)
    bars.write.parquet(f"{tmp_path}/bars")
    stored = spark.read.parquet(f"{tmp_path}/bars")
    text = indicators(stored, BarGrid(3600))._jdf.queryExecution().executedPlan().toString()
    top = text[: text.index("Union")]
    assert top.count("Exchange") == 1 and top.count("Sort ") == 1
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("scale", [3e-7, 1.0, 1e12])
def test_sums_are_exact_at_any_price(spark, series, scale):
    closes = [c * scale for c in (3.0, 4.0, 2.0, 4.0, 1.0)]
    rows = by_date(moving_averages(series(T=closes), DAILY, [2], places=None))
    want = [closes[0]] + [(a + b) / 2 for a, b in zip(closes, closes[1:])]
    assert [r["sma_2"] for r in rows] == pytest.approx(want, rel=1e-12)


def test_negative_ties_round_away_from_zero(spark):
    df = spark.sql("SELECT explode(array(-0.125D, 0.125D, -2.675D, 2.675D, 0.0049999999995D)) AS v")
    got = [r[0] for r in df.select(steady_round(F.col("v"))).collect()]
    assert got == [-0.13, 0.13, -2.68, 2.68, 0.0]


def test_recent_crosses_sparse_chunks(spark):
    days = [0, 1, 2, 50, 51, 400, 900]
    df = spark.createDataFrame([("T", day(n), float(n)) for n in days], "ticker string, Date timestamp_ntz, Close double")
    for rows in (1, 2, 4, 6, 9):
        got = [r["Close"] for r in by_date(recent(df, rows, BarGrid(86_400, 7)))]
        assert got == [float(n) for n in days[-rows:]]


@pytest.mark.parametrize("query, table", [("evaluated_bars_full", "lineitem"), ("position_trades", "events")])
def test_the_fact_table_is_scanned_once(spark, sf, query, table):
    df = REGISTRY[query](spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum(f"{table}.parquet" in line for line in plan.splitlines()) == 1
