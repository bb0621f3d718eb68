"""The whole run: store raw bars, evaluate them, export, backtest, train."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import classification, features, model, performance, positions, reports
from tickloom.operators.chunks import BarGrid
from tickloom.operators.decisions import evaluate, with_signal_defaults
from tickloom.operators.indicators import PARTIAL, IndicatorSpec
from tickloom.operators.positions import TradeRules
from tickloom.operators.snapshot import latest, serving_view
from tickloom.session import use_checkpoints
from tickloom.sinks.writers import export, replace_serving, write_table
from tickloom.sources.bars import first_per_bar
from tickloom.sources.tables import (
    missing_tickers,
    nulls_for_nan,
    read_table,
    with_fundamental_defaults,
)

RAW = "stock_prices_raw"
EVALUATED = "stock_backtests"
SERVING = "stock_serving"


@dataclass(frozen=True)
class Ingested:
    quality: DataFrame
    missing: DataFrame | None


def ingest(spark: SparkSession, bars: DataFrame, tickers: DataFrame | None = None) -> Ingested:
    """Store raw bars; report their quality and the tickers without any bar.

    Of several rows for one (ticker, Date) the smallest by value is stored.
    """
    rows = with_fundamental_defaults(nulls_for_nan(bars))
    values = [c for c in rows.columns if c not in ("ticker", "Date")]
    write_table(first_per_bar(rows, F.struct(*values)).select(*rows.columns), RAW)
    stored = spark.table(RAW)
    missing = None if tickers is None else missing_tickers(tickers, stored)
    return Ingested(reports.quality_report(stored), missing)


def evaluate_stored(
    spark: SparkSession, grid: BarGrid, spec: IndicatorSpec = PARTIAL, raw_path: str | None = None
) -> DataFrame:
    """Evaluate the stored bars and store the result. Returns the stored table."""
    write_table(evaluate(read_table(spark, RAW, raw_path), grid, spec), EVALUATED)
    return spark.table(EVALUATED)


def export_stored(spark: SparkSession, folder: str, grid: BarGrid) -> DataFrame:
    """Write all export files of the stored table; one row that sums it up."""
    df = read_table(spark, EVALUATED)
    export(df, folder, grid)
    return reports.export_summary(df)


def publish_serving(spark: SparkSession, scored: DataFrame) -> int:
    """Replace the serving table by the newest row of each ticker."""
    return replace_serving(spark, serving_view(latest(scored)), SERVING)


def run_backtest(
    signals: DataFrame, grid: BarGrid, rules: TradeRules = TradeRules()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metrics, trades, equity curve) of all tickers of `signals`; the fold runs once."""
    use_checkpoints(signals.sparkSession)
    replayed = positions.replay(with_signal_defaults(signals, grid), grid, rules).checkpoint()
    return (
        performance.backtest_metrics(replayed, rules),
        positions.trades(replayed),
        positions.equity_curve(replayed),
    )


def train_and_score(
    matrix: DataFrame, spec: model.ModelSpec = model.ModelSpec(), train_share: float = 0.8
) -> tuple[model.PipelineModel, DataFrame, DataFrame]:
    """(model, scored test rows, evaluation) from a stored feature matrix."""
    rows = features.split_by_position(matrix, train_share)
    fitted = model.train(rows.filter("is_train").drop("is_train"), spec)
    scored = model.predict(fitted, rows.filter("NOT is_train").drop("is_train"))
    counts = classification.classification_metrics(classification.confusion(scored))
    return fitted, scored, counts.withColumn("auc", classification.auc(scored).scalar())
