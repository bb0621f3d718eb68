from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from conftest import day
from pyspark.sql import functions as F

from checks.inputs import DAYS, HOURS, daily_bars, dip_signals, fundamentals, hourly_bars
from tickloom.functions.columns import json_safe, local_naive, utc_naive
from tickloom.operators import classification, features, model, reports, strategies
from tickloom.operators.chunks import DAILY, BarGrid
from tickloom.operators.strategies import Strategy
from tickloom.plans import pipeline
from tickloom.schemas import BARS, TICKERS
from tickloom.session import use_checkpoints
from tickloom.sinks.writers import (
    write_csv,
    write_history,
    write_json,
    write_parquet,
    write_table,
    write_validated,
)
from tickloom.sources import tables


def test_ingest_evaluate_export_twice(spark, sf, tmp_path):
    bars = daily_bars(spark, sf)
    listed = tables.local_rows(spark, [("Brand#11", "a", "b"), ("NONE", "c", "d")], TICKERS)
    for _ in range(2):
        report = pipeline.ingest(spark, bars, listed)
        assert [r.ticker for r in report.missing.collect()] == ["NONE"]
        assert report.quality.count() == 25
        evaluated = pipeline.evaluate_stored(spark, DAYS)
        summary = pipeline.export_stored(spark, str(tmp_path / "out"), DAYS).first()
        assert summary.row_count == bars.count() and summary.ticker_count == 25
    assert {"sma_200", "decision", "dividend_category", "sector"} <= set(evaluated.columns)
    latest = spark.read.csv(f"{tmp_path}/out/latest_csv", header=True)
    assert latest.count() == 25
    folders = Path(tmp_path / "out/history").glob("safe_ticker=Brand*11/since=*/*.json")
    files = sorted(folders)
    dates = [json.loads(line)["Date"] for f in files for line in f.read_text().splitlines()]
    assert dates == sorted(dates) and len(dates) == bars.filter("ticker = 'Brand#11'").count()
    scored = evaluated.withColumns({"confidence": F.lit(0.5), "fundamental_score": F.lit(1.0)})
    assert pipeline.publish_serving(spark, scored) == 25
    assert pipeline.publish_serving(spark, scored) == 25


def test_failed_write_leaves_the_old_rows(spark):
    rows = spark.range(5)
    write_table(rows, "kept_rows")
    broken = rows.select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_table(broken, "kept_rows")
    assert spark.table("kept_rows").count() == 5
    assert len(spark.catalog.listTables(pattern="kept_rows__v*")) == 1
    running = spark.table("kept_rows")
    write_table(spark.table("kept_rows").filter("id < 2"), "kept_rows")  # reads what it replaces
    assert spark.table("kept_rows").count() == 2 and running.count() == 5
    write_table(rows.select("id", F.lit("x").alias("more")), "kept_rows")
    assert spark.table("kept_rows").columns == ["id", "more"]
    assert len(spark.catalog.listTables(pattern="kept_rows__v*")) == 2


def test_table_without_versions_is_replaced(spark):
    spark.range(3).write.saveAsTable("plain_rows")
    write_table(spark.range(7), "plain_rows")
    assert spark.table("plain_rows").count() == 7


def test_json_keeps_nulls_and_iso_dates(spark, series, tmp_path):
    bars = series(T=[None]).withColumn("Date", F.expr("Date + INTERVAL '0.123456' SECOND"))
    write_json(bars, f"{tmp_path}/json")
    parts = Path(f"{tmp_path}/json").glob("part-*.json")  # one of them may be empty
    lines = [line for p in parts for line in p.read_text().splitlines()]
    assert [json.loads(line)["Close"] for line in lines] == [None]
    assert json.loads(lines[0])["Date"] == "2024-01-01T00:00:00.123456"
    write_csv(bars, f"{tmp_path}/csv")
    assert tables.read_csv(spark, f"{tmp_path}/csv", bars.schema).collect() == bars.collect()


def test_reading_back(spark, series, tmp_path):
    bars = series(T=[1.0, 2.0], U=[3.0])
    write_parquet(bars, f"{tmp_path}/parquet", "ticker")
    assert tables.read_table(spark, "absent_table", f"{tmp_path}/parquet").count() == 3
    write_csv(bars, f"{tmp_path}/bars.csv")
    found = tables.read_first(spark, [f"{tmp_path}/none.csv", f"{tmp_path}/bars.csv"], bars.schema)
    assert sorted(map(str, found.collect())) == sorted(map(str, bars.collect()))
    assert tables.read_csv(spark, f"{tmp_path}/bars.csv", bars.schema).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_first(spark, [f"{tmp_path}/none"])
    assert write_validated(bars, f"{tmp_path}/validated")
    assert not write_validated(bars.limit(0), f"{tmp_path}/nothing")
    assert not Path(f"{tmp_path}/nothing").exists()
    one = tables.for_ticker(tables.read_table(spark, "x", f"{tmp_path}/parquet"), "U")
    assert "PartitionFilters: [isnotnull(ticker" in one._jdf.queryExecution().executedPlan().toString()
    assert tables.for_ticker(bars, "nobody").isEmpty()


def test_nan_becomes_null(spark, series):
    bars = tables.nulls_for_nan(series(T=[1.0, float("nan")]))
    assert sorted(map(str, (r.Close for r in bars.collect()))) == ["1.0", "None"]


def test_history_splits_long_tickers(spark, series, tmp_path):
    write_history(series(A=[1.0] * 10), f"{tmp_path}/h", BarGrid(86_400, 4))
    assert len(list(Path(f"{tmp_path}/h").glob("safe_ticker=A/since=*/*.json"))) >= 3


def test_filter_reaches_the_scan(spark, sf):
    text = (
        spark.read.parquet(f"{sf}/lineitem.parquet")
        .filter("l_discount > 0.05")
        .select("l_discount")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "GreaterThan(l_discount,0.05)" in text
    assert "ReadSchema: struct<l_discount:double>" in text


def test_joining_a_dimension_runs_no_job(spark, series):
    bars = series(A=[1.0], B=[2.0], C=[3.0])
    names = bars.select("ticker", F.lower("ticker").alias("name")).limit(2)
    spark.sparkContext.setJobGroup("plan only", "")
    joined = tables.join_dimension(bars, names, "ticker")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan only")
    assert joined.count() == 3


def test_zones(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 15:00:00Z' AS at")
    row = df.select(utc_naive(F.col("at")).alias("u"), local_naive(F.col("at"), F.lit("Asia/Tokyo")).alias("l")).first()
    assert row.u == dt.datetime(2024, 1, 1, 15) and row.l == dt.datetime(2024, 1, 2)


def test_json_safe(spark):
    df = spark.sql("SELECT * FROM VALUES (double('nan')), (double('-infinity')), (NULL), (1.005), (-0.001) AS t(v)")
    got = [r[0] for r in df.select(json_safe(F.col("v").cast("double"))).collect()]
    assert got == [0.0, 0.0, 0.0, 1.01, 0.0]


@pytest.mark.parametrize("n", [1, 4, 5, 17, 100])
def test_split_is_exact(spark, n):
    rows = [(f"T{i % 3}", day(i // 3 * 11), i % 2) for i in range(n)]
    df = spark.createDataFrame(rows, "ticker string, Date timestamp_ntz, label int")
    got = features.split_by_position(df).collect()
    train = sorted((r.Date, r.ticker) for r in got if r.is_train)
    assert train == sorted((d, t) for t, d, _ in rows)[: int(n * 0.8)] and len(got) == n


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)


def test_auc_with_ties_and_near_scores(spark):
    pairs = [((i * 7) % 3 == 0, round(((i * 37) % 50) / 50 + (i % 2) * 1e-9, 12)) for i in range(200)]
    df = spark.createDataFrame([(int(y), s) for y, s in pairs], "label int, score double")
    assert classification.auc(df).first().auc == pytest.approx(brute_auc(pairs), abs=1e-6)
    one_class = df.filter("label = 1")
    assert classification.auc(one_class).first().auc is None


def test_auc_of_scores_outside_0_1_and_without_a_score(spark):
    pairs = [(i % 3 == 0, (i * 37 % 101) * 1e6 - 5e7) for i in range(300)]
    df = spark.createDataFrame([(int(y), x) for y, x in pairs], "label int, score double")
    assert classification.auc(df).first().auc == pytest.approx(brute_auc(pairs), abs=1e-6)
    unknown = df.unionByName(spark.sql("SELECT 1 AS label, CAST(NULL AS DOUBLE) AS score"))
    with pytest.raises(Exception, match="no score"):
        classification.auc(unknown).first()


def test_ingest_stores_each_bar_once(spark, series):
    bars = series(T=[2.0, 3.0], U=[5.0])
    again = bars.withColumn("Close", F.col("Close") + 1)
    for rows in (bars.unionByName(again), again.unionByName(bars).repartition(3)):
        pipeline.ingest(spark, rows)
        stored = spark.table(pipeline.RAW).select("ticker", "Date", "Close")
        assert sorted(stored.collect()) == sorted(bars.select("ticker", "Date", "Close").collect())


def test_report_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    rows = {r["class"]: r for r in classification.classification_report(classification.confusion(df)).collect()}
    assert rows["HOLD"].f1 == 1.0 and rows["BUY"].f1 == 0.0 and rows["macro avg"].precision == 0.5


def test_feature_row_paths_agree(spark, sf):
    """Features from stored training rows equal those made in one pass."""
    bars, facts = daily_bars(spark, sf), fundamentals(spark, sf)
    from tickloom.operators.indicators import forward_label, indicators

    rows = indicators(bars, DAYS, features.TRAINING_SPEC)
    rows = rows.join(forward_label(bars, DAYS).select("ticker", "Date", "label"), ["ticker", "Date"])
    rows = rows.join(facts.select("ticker", "per", "pbr", "roe", "fundamental_score"), "ticker")
    stepwise = features.feature_matrix(rows, DAYS)
    direct = features.training_matrix(bars, facts, DAYS)
    assert sorted(map(str, stepwise.collect())) == sorted(map(str, direct.collect()))


def test_train_score_save_load_and_backtest(spark, sf, tmp_path):
    use_checkpoints(spark)
    matrix = features.training_matrix(daily_bars(spark, sf), fundamentals(spark, sf), DAYS).checkpoint()
    fitted, scored, evaluation = pipeline.train_and_score(matrix, model.ModelSpec(trees=3, depth=3))
    row = evaluation.first()
    assert 0.0 <= row.auc <= 1.0 and row.tp + row.fp + row.fn + row.tn == scored.count()
    assert {r.decision for r in scored.select("decision").distinct().collect()} <= {"BUY", "HOLD"}
    top = model.importances(fitted, spark).collect()
    assert len(top) == 10 and top[0].importance >= top[-1].importance
    model.save_model(fitted, f"{tmp_path}/m", spark)
    again = model.predict(model.load_model(f"{tmp_path}/m"), matrix.limit(20))
    assert again.count() == 20
    meta = json.loads(next(Path(f"{tmp_path}/m/metadata").glob("*.json")).read_text())
    assert meta["n_features"] == 17


def test_backtest_of_all_tickers(spark, sf):
    metrics, closed, curve = pipeline.run_backtest(dip_signals(spark, sf), HOURS)
    assert metrics.count() == 5 and closed.count() == sum(r.total_trades for r in metrics.collect())
    assert curve.count() == hourly_bars(spark, sf).count()


@pytest.mark.parametrize("chunk_bars", [5, 1000])
def test_strategy_curve_and_metrics_by_hand(spark, series, chunk_bars):
    closes = [100 + (i * 17) % 23 for i in range(40)]
    bars = series(T=[float(c) for c in closes])
    grid = BarGrid(86_400, chunk_bars)
    metrics, curve = strategies.evaluate_strategy(bars, grid, Strategy("SMA_Cross", fast=2, slow=5), Strategy())
    sma = lambda n, i: sum(closes[i - n + 1 : i + 1]) / n if i >= n - 1 else None
    value, peak, low, expected = 1.0, 1.0, 0.0, []
    for i in range(1, len(closes)):
        fast, slow = sma(2, i - 1), sma(5, i - 1)
        inside = slow is not None and fast > slow
        value *= 1 + (closes[i] / closes[i - 1] - 1) * inside
        peak = max(peak, value)
        low = min(low, value / peak - 1)
        expected.append(value)
    got = sorted(curve.filter("strategy LIKE 'SMA%'").collect(), key=lambda r: r.Date)
    assert [r.cumulative for r in got] == pytest.approx(expected)
    assert got[-1].base_cumulative == pytest.approx(closes[-1] / closes[0])
    rows = {r.strategy: r for r in metrics.collect()}
    assert rows["SMA_Cross(2,5)"].max_drawdown_pct == pytest.approx(low * 100, abs=0.006)
    assert rows["Hold"].cagr_pct == pytest.approx(((closes[-1] / closes[0]) ** (252 / 39) - 1) * 100, abs=0.006)
    chart = strategies.chart_response(curve, metrics).collect()
    assert sum(len(r.dates) for r in chart) == 2 * 39


def test_no_bars_give_no_rows(spark):
    empty = spark.createDataFrame([], BARS)
    metrics, curve = strategies.evaluate_strategy(empty, DAILY, Strategy("RSI"))
    assert metrics.isEmpty() and curve.isEmpty()
    assert reports.export_summary(empty).first().row_count == 0
