"""One registered query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import (
    DAYS,
    HOURS,
    daily_bars,
    damped_bars,
    dip_signals,
    fundamentals,
    hourly_bars,
    scored_documents,
    table,
)
from tickloom.functions.columns import (
    clip,
    dividend_tier,
    json_safe,
    local_naive,
    or_default,
    safe_name,
    steady_round,
    utc_naive,
)
from tickloom.operators import classification, decisions, features, indicators, messages, model
from tickloom.operators import performance, positions, reports, snapshot, strategies
from tickloom.operators.indicators import FULL, PARTIAL, UNGUARDED, IndicatorSpec
from tickloom.operators.positions import TradeRules
from tickloom.operators.strategies import Strategy
from tickloom.session import checkpoint_dir, use_checkpoints
from tickloom.sinks import writers
from tickloom.sources import tables
from tickloom.sources.bars import first_per_bar
from tickloom.streaming import bars as bar_streams
from tickloom.streaming import consume, stateful

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

RULES_20 = TradeRules()
RULES_5 = TradeRules(holding_period=5)
RSI_50 = Strategy("RSI", threshold=50.0)
RSI_40 = Strategy("RSI", threshold=40.0)
SMA_20_50 = Strategy("SMA_Cross", fast=20, slow=50)
SMA_5_20 = Strategy("SMA_Cross", fast=5, slow=20)
HOLD = Strategy()
GRID = (RSI_50, RSI_40, SMA_20_50, SMA_5_20, HOLD)


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


# Bars and sources


@query
def bars_hourly(spark, sf):
    return hourly_bars(spark, sf)


@query
def bars_daily(spark, sf):
    return daily_bars(spark, sf)


@query
def trailing_period(spark, sf):
    return tables.trailing_period(daily_bars(spark, sf), "730 days").select(
        "ticker", "Date", "Close"
    )


@query
def ticker_universe(spark, sf):
    return tables.universe(hourly_bars(spark, sf), ["click", "purchase"])


@query
def ticker_universe_table(spark, sf):
    wanted = fundamentals(spark, sf).filter(F.col("fundamental_score") >= 50)
    return tables.universe(daily_bars(spark, sf), wanted).select("ticker", "Date", "Close")


@query
def missing_tickers(spark, sf):
    wanted = table(spark, sf, "documents").select(F.col("doc_id").alias("ticker"))
    seen = table(spark, sf, "labels").select(F.col("doc_id").alias("ticker"))
    return tables.missing_tickers(wanted, seen)


@query
def dedup_bars(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("ticker"),
        F.expr("make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), 0, 0)").alias("Date"),
        "ts",
        "event_id",
        "value",
    )
    return first_per_bar(rows, F.col("ts"))


@query
def union_sources(spark, sf):
    hours = hourly_bars(spark, sf).select("ticker", "Date", "Close", "Volume")
    days = daily_bars(spark, sf).select("ticker", "Date", "Close", "dividend_yield")
    return tables.union_all([hours, days])


@query
def fundamental_defaults(spark, sf):
    facts = fundamentals(spark, sf).select(
        "ticker",
        F.col("per").alias("pe_ratio"),
        F.col("roe").alias("dividend_yield"),
        F.when(F.col("pbr").isNotNull(), F.col("sector")).alias("sector"),
    )
    return tables.with_fundamental_defaults(facts)


@query
def describe_tickers(spark, sf):
    listed = fundamentals(spark, sf).filter(F.col("per").isNotNull())
    listed = listed.select("ticker", F.lower("ticker").alias("name"), "sector")
    bars = daily_bars(spark, sf).select("ticker", "Date", "Close")
    return tables.describe_tickers(bars, listed)


# Indicators


@query
def sma_partial(spark, sf):
    bars = hourly_bars(spark, sf).select("ticker", "Date", "Close")
    return indicators.moving_averages(bars, HOURS, (5, 20, 50, 200))


@query
def sma_full(spark, sf):
    bars = daily_bars(spark, sf).select("ticker", "Date", "Close")
    return indicators.moving_averages(bars, DAYS, (5, 25, 75), full=True)


@query
def sma_unrounded(spark, sf):
    bars = hourly_bars(spark, sf).select("ticker", "Date", "Close")
    df = indicators.moving_averages(bars, HOURS, (20, 50), full=True, places=None)
    return df.withColumns({c: steady_round(F.col(c), 6) for c in ("sma_20", "sma_50")})


def _indicators(spark, sf, spec: IndicatorSpec) -> DataFrame:
    bars = hourly_bars(spark, sf).select("ticker", "Date", "Close")
    return indicators.indicators(bars, HOURS, spec)


@query
def cross_signals(spark, sf):
    return _indicators(spark, sf, PARTIAL).select(
        "ticker", "Date", "sma_20", "sma_50", "golden_cross", "dead_cross"
    )


@query
def cross_signals_full(spark, sf):
    return _indicators(spark, sf, FULL).select("ticker", "Date", "golden_cross", "dead_cross")


@query
def cross_fallback(spark, sf):
    bars = hourly_bars(spark, sf).select("ticker", "Date", "Close")
    averages = indicators.moving_averages(bars, HOURS, (25, 75))
    return decisions.with_signal_defaults(averages, HOURS)


@query
def rsi_partial(spark, sf):
    return _indicators(spark, sf, PARTIAL).select("ticker", "Date", "rsi_14")


@query
def rsi_full(spark, sf):
    return _indicators(spark, sf, FULL).select("ticker", "Date", "rsi_14")


@query
def rsi_unguarded(spark, sf):
    rsi = steady_round(F.col("rsi_14"), 6).alias("rsi_14")
    return _indicators(spark, sf, UNGUARDED).select("ticker", "Date", rsi)


@query
def bollinger_partial(spark, sf):
    return _indicators(spark, sf, PARTIAL).select("ticker", "Date", "bb_upper", "bb_lower")


@query
def bollinger_full(spark, sf):
    return _indicators(spark, sf, FULL).select("ticker", "Date", "bb_upper", "bb_lower")


@query
def other_periods(spark, sf):
    spec = IndicatorSpec(
        sma=(3, 10), cross=(3, 10), rsi=7, bands=12, full_windows=True, round_band_std=False
    )
    return indicators.indicators(hourly_bars(spark, sf), HOURS, spec).select(
        "ticker", "Date", "sma_3", "sma_10", "golden_cross", "dead_cross", "rsi_7", "bb_upper", "bb_lower"
    )


@query
def daily_returns(spark, sf):
    return _indicators(spark, sf, PARTIAL).select("ticker", "Date", "daily_return_pct")


@query
def returns(spark, sf):
    bars = daily_bars(spark, sf).select("ticker", "Date", "Close")
    df = indicators.price_changes(bars, DAYS, (1, 5, 20))
    changes = [steady_round(F.col(f"return_{k}"), 6).alias(f"return_{k}") for k in (1, 5, 20)]
    return df.select("ticker", "Date", *changes)


@query
def forward_label(spark, sf):
    bars = daily_bars(spark, sf).select("ticker", "Date", "Close")
    return indicators.forward_label(bars, DAYS)


# Decisions


@query
def dividend_tiers(spark, sf):
    tier = dividend_tier(F.col("l_discount")).alias("dividend_category")
    return table(spark, sf, "lineitem").groupBy("l_discount", tier).agg(F.count("*").alias("n"))


@query
def dividend_tier_last(spark, sf):
    bars = daily_bars(spark, sf).select("ticker", "Date", "dividend_yield")
    return decisions.add_latest_tier(bars)


@query
def evaluated_bars(spark, sf):
    return decisions.evaluate(hourly_bars(spark, sf), HOURS)


@query
def evaluated_bars_full(spark, sf):
    return decisions.evaluate(daily_bars(spark, sf), DAYS, FULL)


@query
def decision_distribution(spark, sf):
    bars = hourly_bars(spark, sf).select("ticker", "Date", "Close")
    return reports.distribution(decisions.evaluate(bars, HOURS))


@query
def latest_signals_top20(spark, sf):
    df = decisions.evaluate(hourly_bars(spark, sf), HOURS)
    columns = ["ticker", "Date", "Close", "sma_20", "sma_50", "rsi_14"]
    return snapshot.newest(df, 20, *columns, "decision", "decision_strength")


# Snapshots and reports


@query
def latest_snapshot(spark, sf):
    return snapshot.latest_evaluated(hourly_bars(spark, sf), HOURS)


@query
def latest_bars(spark, sf):
    return snapshot.latest(daily_bars(spark, sf))


@query
def ticker_history(spark, sf):
    return snapshot.history(hourly_bars(spark, sf), "purchase")


@query
def newest_three(spark, sf):
    return snapshot.newest(hourly_bars(spark, sf), 3)


@query
def serving_view(spark, sf):
    bars = daily_bars(spark, sf)
    facts = fundamentals(spark, sf).select("ticker", "company_name", "fundamental_score")
    rows = tables.join_dimension(snapshot.latest_evaluated(bars, DAYS), facts, "ticker")
    return snapshot.serving_view(rows.withColumn("confidence", F.lit(0.5)))


@query
def dividend_ranking(spark, sf):
    latest = snapshot.latest(daily_bars(spark, sf))
    return snapshot.dividend_ranking(latest.select("ticker", "dividend_yield"))


@query
def quality_report(spark, sf):
    facts = fundamentals(spark, sf).select("ticker", "company_name", "sector")
    return reports.quality_report(
        tables.join_dimension(daily_bars(spark, sf), facts, "ticker")
    )


@query
def export_summary(spark, sf):
    return reports.export_summary(daily_bars(spark, sf))


@query
def ticker_spans(spark, sf):
    return reports.per_ticker_span(hourly_bars(spark, sf)).withColumn(
        "safe_ticker", safe_name(F.concat("ticker", F.lit(".T")))
    )


@query
def safe_values(spark, sf):
    """Clipping, filling and JSON-safe rounding over the fundamentals."""
    facts = fundamentals(spark, sf)
    return facts.select(
        "ticker",
        json_safe(F.col("per")).alias("per"),
        json_safe(F.col("pbr")).alias("pbr"),
        steady_round(clip(or_default(F.col("roe"), 0.1), 0.0, 0.25), 4).alias("roe"),
        or_default(F.when(F.col("per").isNotNull(), F.col("sector")), "Unknown").alias("sector"),
    )


# Positions and performance


def _replay(spark, sf, rules: TradeRules) -> DataFrame:
    return positions.replay(dip_signals(spark, sf), HOURS, rules)


def _trades(spark, sf, rules: TradeRules) -> DataFrame:
    df = positions.trades(_replay(spark, sf, rules))
    return df.withColumns(
        {"pnl": steady_round(F.col("pnl")), "pnl_pct": steady_round(F.col("pnl_pct"), 4)}
    )


@query
def position_trades(spark, sf):
    return _trades(spark, sf, RULES_20)


@query
def position_trades_hold5(spark, sf):
    return _trades(spark, sf, RULES_5)


@query
def equity_curve(spark, sf):
    return positions.equity_curve(_replay(spark, sf, RULES_5))


@query
def drawdown_runs(spark, sf):
    df = performance.drawdowns(_replay(spark, sf, RULES_5))
    return df.withColumn("drawdown", steady_round(F.col("drawdown"), 6))


@query
def backtest_metrics(spark, sf):
    return performance.backtest_metrics(_replay(spark, sf, RULES_20), RULES_20)


@query
def backtest_metrics_hold5(spark, sf):
    return performance.backtest_metrics(_replay(spark, sf, RULES_5), RULES_5)


# Strategies


def _curve(spark, sf, *chosen: Strategy) -> DataFrame:
    rows = strategies.strategy_returns(damped_bars(spark, sf), HOURS, chosen)
    df = strategies.strategy_curve(rows)
    rounded = {
        c: steady_round(F.col(c), 6) for c in ("strategy_return", "cumulative", "base_cumulative")
    }
    return df.drop("chunk").withColumns(rounded)


@query
def strategy_rsi(spark, sf):
    return _curve(spark, sf, RSI_50)


@query
def strategy_sma_cross(spark, sf):
    return _curve(spark, sf, SMA_20_50)


@query
def strategy_buy_hold(spark, sf):
    return _curve(spark, sf, HOLD)


@query
def strategy_metrics(spark, sf):
    rows = strategies.strategy_returns(damped_bars(spark, sf), HOURS, (RSI_50,))
    return strategies.strategy_metrics(rows)


@query
def strategy_grid(spark, sf):
    rows = strategies.strategy_returns(damped_bars(spark, sf), HOURS, GRID)
    return strategies.strategy_metrics(rows)


@query
def base_vs_strategy_curve(spark, sf):
    """Buy-and-hold of the hours with two events or more, on the RSI strategy's dates."""
    bars = hourly_bars(spark, sf)
    lifted = F.round(3000 + F.col("Close"), 2).alias("Close")
    busy = bars.filter(F.col("Volume") >= 2).select("ticker", "Date", lifted)
    base = strategies.strategy_curve(strategies.strategy_returns(busy, HOURS, (HOLD,)))
    base = base.select("ticker", "Date", F.col("cumulative").alias("base"))
    own = strategies.strategy_returns(damped_bars(spark, sf), HOURS, (RSI_50,))
    own = strategies.strategy_curve(own).select("ticker", "Date", "cumulative")
    df = strategies.reindex_forward_fill(base, own, "base", HOURS)
    return df.withColumns({c: steady_round(F.col(c), 6) for c in ("base", "cumulative")})


# Messages


def _messages(spark, sf) -> DataFrame:
    bars = hourly_bars(spark, sf)
    listed = bars.select("ticker").distinct().filter(F.col("ticker") != "click")
    listed = listed.select("ticker", F.upper("ticker").alias("name"), F.lit("Web").alias("sector"))
    facts = bars.groupBy("ticker").agg(F.max("High").alias("per")).filter(F.col("ticker") != "view")
    return messages.build_messages(bars, HOURS, listed, facts)


def _event_messages(spark, sf) -> DataFrame:
    """One single-bar message per event, spoilt in a way that depends on its id."""
    kind = F.col("event_id") % 11
    bar = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("Date"),
        F.col("value").alias("Open"),
        F.when(kind == 1, F.col("value") - 1).otherwise(F.col("value")).alias("High"),
        F.col("value").alias("Low"),
        F.when(kind == 2, F.lit(0.0)).when(kind == 3, -F.col("value")).when(kind != 4, F.col("value")).alias("Close"),
        F.when(kind == 5, F.lit("12.7")).when(kind == 6, F.lit("-3")).when(kind != 7, F.lit("10")).alias("Volume"),
    )
    body = F.struct(
        F.when(kind != 8, F.col("event_type")).alias("ticker"),
        F.when(kind == 9, F.array().cast("array<struct<Date:string,Open:double,High:double,Low:double,Close:double,Volume:string>>"))
        .otherwise(F.array(bar))
        .alias("ohlcv"),
    )
    text = F.when(kind == 10, F.lit("{broken")).otherwise(F.to_json(body))
    return table(spark, sf, "events").select("event_id", text.alias("value"))


@query
def message_build(spark, sf):
    doc = F.try_parse_json("value")
    return _messages(spark, sf).select(
        "ticker",
        F.try_variant_get(doc, "$.company_name", "string").alias("company_name"),
        F.try_variant_get(doc, "$.sector", "string").alias("sector"),
        F.size(F.try_variant_get(doc, "$.ohlcv", "array<variant>")).cast("bigint").alias("bars"),
        F.try_variant_get(doc, "$.metadata.rows", "bigint").alias("rows"),
        F.try_variant_get(doc, "$.metadata.start_date", "string").cast("timestamp_ntz").alias("start_date"),
        F.try_variant_get(doc, "$.metadata.end_date", "string").cast("timestamp_ntz").alias("end_date"),
    )


@query
def message_flatten(spark, sf):
    wrapped = messages.add_envelope(_messages(spark, sf))
    checked = messages.validate_messages(messages.parse_messages(wrapped.drop("ticker")))
    return messages.flatten_messages(checked).select(
        "ticker", "Date", "Open", "High", "Low", "Close", "Volume", "per", "company_name", "sector"
    )


@query
def envelope_fields(spark, sf):
    at = F.lit("2024-01-02T03:04:05Z").cast("timestamp")
    doc = F.try_parse_json("value")
    wrapped = messages.add_envelope(_messages(spark, sf), at)
    field = {name: f"$.publish_metadata.{name}" for name in ("source", "schema_version", "published_at")}
    return wrapped.select(
        "ticker", *[F.try_variant_get(doc, path, "string").alias(name) for name, path in field.items()]
    ).withColumn("published_at", F.col("published_at").cast("timestamp").cast("timestamp_ntz"))


@query
def zone_times(spark, sf):
    """Instants as UTC and as the market's own wall-clock time."""
    rows = table(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return rows.select(
        "event_id",
        utc_naive(F.col("at")).alias("utc"),
        local_naive(F.col("at"), F.lit("Asia/Tokyo")).alias("tokyo"),
    )


@query
def message_more_fields(spark, sf):
    """Keys of bars and fundamentals that are not in the usual lists."""
    bars = hourly_bars(spark, sf).withColumn("Adj Close", F.col("Close") * 2)
    facts = bars.groupBy("ticker").agg(F.max("High").alias("beta"), F.min("Low").alias("per"))
    built = messages.build_messages(bars, HOURS, None, facts)
    checked = messages.validate_messages(messages.parse_messages(built.drop("ticker")))
    return messages.flatten_messages(
        checked, more_bar_fields=["Adj Close"], more_fundamentals=["beta"]
    ).select("ticker", "Date", "Close", F.col("Adj Close").alias("adjusted"), "per", "beta")


@query
def message_other_fields(spark, sf):
    """Keys that nobody named, found in the messages, and volumes that are not whole."""
    bars = hourly_bars(spark, sf).withColumns(
        {"Adj Close": F.col("Close") * 2, "Trades": F.col("Volume") + 1, "Volume": F.col("Volume") + 0.5}
    )
    facts = bars.groupBy("ticker").agg(F.max("High").alias("beta"), F.min("Low").alias("per"))
    facts = facts.withColumn("exchange", F.concat(F.lit("X"), F.length("ticker")))
    built = messages.build_messages(bars, HOURS, None, facts)
    checked = messages.validate_messages(messages.parse_messages(built.drop("ticker")))
    use_checkpoints(spark)
    flat = messages.flatten_messages(checked, others=True).drop("Volume").checkpoint()
    found = messages.spread(messages.spread(flat, "other_bar"), "other_fundamentals")
    names = ["ticker", "Date", "Close", "Volume", "Trades", "per", "beta", "exchange"]
    return found.select(*names, F.col("Adj Close").alias("adjusted"))


@query
def message_rejects(spark, sf):
    """What is wrong with the messages that fail, error by error."""
    checked = messages.validate_messages(messages.parse_messages(_event_messages(spark, sf)))
    errors = messages.rejected_messages(checked).select(F.explode("errors").alias("e"))
    return errors.groupBy(F.col("e.code").alias("code")).agg(F.count("*").alias("n"))


@query
def message_validation(spark, sf):
    checked = messages.validate_messages(messages.parse_messages(_event_messages(spark, sf)))
    return checked.select(
        "event_id",
        "is_valid",
        F.size("errors").cast("bigint").alias("n_errors"),
        F.array_join(F.col("errors.code"), "|").alias("codes"),
    )


@query
def message_stats(spark, sf):
    return messages.message_stats(
        messages.validate_messages(messages.parse_messages(_event_messages(spark, sf)))
    )


@query
def publish_stats(spark, sf):
    """A message counts as sent if it is a JSON document."""
    parsed = messages.parse_messages(_event_messages(spark, sf))
    return messages.publish_stats(parsed.withColumn("sent", F.col("doc").isNotNull()))


@query
def json_props(spark, sf):
    events = table(spark, sf, "events")
    props = F.from_json("props", "k bigint, missing string")
    return events.select(
        "event_id",
        props["k"].alias("k"),
        F.coalesce(props["missing"], F.lit("none")).alias("missing"),
    )


@query
def message_stream(spark, sf):
    """The messages through a stream of files, drained into a table."""
    folder = f"{checkpoint_dir(spark)}/message_stream_{uuid.uuid4().hex}"
    messages.add_envelope(_messages(spark, sf)).select("value").write.text(f"{folder}/in")
    consume.drain_messages(spark, f"{folder}/in", f"{folder}/out", f"{folder}/progress", whole_files=False)
    return spark.read.parquet(f"{folder}/out/valid").select(
        "ticker", "Date", "Open", "High", "Low", "Close", "Volume", "per", "company_name", "sector"
    )


@query
def bar_stream(spark, sf):
    """Hourly bars from a stream of events, and those the watermark still keeps open."""
    folder = f"{checkpoint_dir(spark)}/bar_stream_{uuid.uuid4().hex}"
    events = (
        spark.readStream.schema(table(spark, sf, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
    )
    fields = F.col("event_type"), F.col("ts"), F.col("value")
    built = bar_streams.stream_bars(events, *fields)
    _drain(built.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    emitted = spark.read.schema(built.schema).parquet(f"{folder}/out")
    return bar_streams.with_open_bars(emitted, table(spark, sf, "events"), *fields)


@query
def evaluation_stream(spark, sf):
    """Stored bars through a stream that evaluates them, two files per batch."""
    folder = f"{checkpoint_dir(spark)}/evaluation_stream_{uuid.uuid4().hex}"
    hours = hourly_bars(spark, sf).select("ticker", "Date", "Close")
    hours.repartitionByRange(4, "Date").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(hours.schema).option("maxFilesPerTrigger", 2)
    stream = stream.parquet(f"{folder}/in")
    bar_streams.evaluate_stream(spark, stream, f"{folder}/state", HOURS).awaitTermination()
    return bar_streams.current_rows(spark, f"{folder}/state")


def _written_in_parts(df: DataFrame, folder: str, parts: int = 3) -> DataFrame:
    """`df` as files of `parts` spans of time, stored one span after the other, read as a stream."""
    spark = df.sparkSession
    second = F.unix_micros(F.col("Date").cast("timestamp"))
    low, high = df.agg(F.min(second), F.max(second)).first()
    span = ((high or 0) - (low or 0)) // parts + 1
    for part in range(parts):
        here = F.floor((second - F.lit(low or 0)) / span) == part
        df.filter(here).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(df.schema).parquet(f"{folder}/in")


def _passed(df: DataFrame, newest: DataFrame, late: str, date: str = "Date") -> DataFrame:
    """Rows that the watermark of a finished stream has passed."""
    limit = newest.agg(F.max("Date") - F.expr(f"INTERVAL {late}")).scalar()
    return df.filter(F.col(date) < limit)


@query
def stream_dedup(spark, sf):
    """Bars, every third hour once more at another price: the first message's stays."""
    folder = f"{checkpoint_dir(spark)}/stream_dedup_{uuid.uuid4().hex}"
    bars = hourly_bars(spark, sf).withColumn("message", F.lit(1))
    again = bars.filter(F.hour("Date") % 3 == 0).withColumns(
        {"Close": F.col("Close") - 1_000, "message": F.lit(2)}
    )
    # the repeats come first
    sent = again.unionByName(bars)
    once = bar_streams.first_in_time(_written_in_parts(sent, folder), F.col("message"))
    _drain(once.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    return _passed(spark.read.schema(once.schema).parquet(f"{folder}/out"), bars, "2 DAY")


@query
def position_stream(spark, sf):
    """Trades closed in a stream of signals whose bars wait for the watermark."""
    folder = f"{checkpoint_dir(spark)}/position_stream_{uuid.uuid4().hex}"
    signals = dip_signals(spark, sf)
    with stateful.rocksdb(spark):
        rows = stateful.positions_in_time(_written_in_parts(signals, folder), RULES_20)
        _drain(rows.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    stored = spark.read.schema(rows.schema).parquet(f"{folder}/out")
    closed = stateful.closed_trades(_passed(stored, signals, "1 HOUR"))
    return closed.withColumns(
        {"pnl": steady_round(F.col("pnl")), "pnl_pct": steady_round(F.col("pnl_pct"), 4)}
    )


def _drain(writer, folder: str) -> None:
    run = writer.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True)
    run.start().awaitTermination()


# Exports, read back


@query
def serving_table(spark, sf):
    """The serving rows, replaced by themselves: the write reads the table that it replaces."""
    name = f"serving_{uuid.uuid4().hex}"
    newest = snapshot.latest(decisions.evaluate(hourly_bars(spark, sf), HOURS))
    rows = newest.select("ticker", "Date", "Close", "decision", "decision_strength")
    writers.replace_serving(spark, rows.filter(F.lit(False)), name)
    writers.replace_serving(spark, rows, name)
    writers.replace_serving(spark, spark.table(name).withColumn("n", F.lit(1)), name)
    return spark.table(name)


@query
def history_export(spark, sf):
    folder = f"{checkpoint_dir(spark)}/history_{uuid.uuid4().hex}"
    hours = hourly_bars(spark, sf)
    writers.write_history(hours, folder, HOURS)
    back = spark.read.schema(hours.schema).json(folder)
    return back.select(*hours.columns, "safe_ticker")


@query
def csv_export(spark, sf):
    folder = f"{checkpoint_dir(spark)}/csv_{uuid.uuid4().hex}"
    hours = hourly_bars(spark, sf)
    writers.write_csv(hours, folder)
    return tables.read_csv(spark, folder, hours.schema)


# Features and model


def _matrix(spark, sf) -> DataFrame:
    return features.training_matrix(daily_bars(spark, sf), fundamentals(spark, sf), DAYS)


def _stored_matrix(spark, sf) -> DataFrame:
    use_checkpoints(spark)
    return _matrix(spark, sf).checkpoint()


@query
def feature_matrix(spark, sf):
    df = _matrix(spark, sf)
    exact = ("sma_25_above_75", "close_above_sma25")
    return df.withColumns(
        {c: steady_round(F.col(c), 5) for c in features.FEATURES if c not in exact}
    )


@query
def label_distribution(spark, sf):
    return reports.distribution(_matrix(spark, sf).select("label"), "label")


@query
def train_test_split(spark, sf):
    rows = _stored_matrix(spark, sf).select("ticker", "Date", "label")
    return features.split_by_position(rows)


@query
def class_weight(spark, sf):
    rows = _stored_matrix(spark, sf).select("ticker", "Date", "label")
    df = features.class_weight(features.split_by_position(rows).filter("is_train"))
    return df.withColumn("scale_pos_weight", steady_round(F.col("scale_pos_weight"), 6))


@query
def classification_metrics(spark, sf):
    counts = classification.confusion(scored_documents(spark, sf))
    return classification.classification_metrics(counts)


@query
def classification_report(spark, sf):
    counts = classification.confusion(scored_documents(spark, sf))
    return classification.classification_report(counts)


@query
def auc_rank_sum(spark, sf):
    return classification.auc(scored_documents(spark, sf))


def _trained(spark, sf):
    rows = features.split_by_position(_stored_matrix(spark, sf))
    fitted = model.train(rows.filter("is_train").drop("is_train"))
    return fitted, rows.filter(~F.col("is_train")).drop("is_train")


@query
def gbt_scores(spark, sf):
    fitted, held_out = _trained(spark, sf)
    return model.predict(fitted, held_out).select(
        "ticker", "Date", "label", "prediction", "score", "decision", "confidence"
    )


@query
def gbt_evaluation(spark, sf):
    fitted, held_out = _trained(spark, sf)
    scored = model.predict(fitted, held_out).checkpoint()
    counts = classification.classification_metrics(classification.confusion(scored))
    return counts.withColumn("auc", classification.auc(scored).scalar())


@query
def top_importances(spark, sf):
    fitted, _ = _trained(spark, sf)
    return model.importances(fitted, spark)
