"""Feature matrix, labels, split by position and class weight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.columns import clip, flag, or_default, ratio, seconds_of
from tickloom.operators.chunks import CHUNK, BarGrid, in_chunk, with_lookback
from tickloom.operators.indicators import (
    IndicatorSpec,
    add_indicators,
    rolling_volatility,
)
from tickloom.sources.tables import join_dimension

# Feature names in the order of the model's input vector.
FEATURES = [
    "sma_5_ratio",
    "sma_25_ratio",
    "sma_75_ratio",
    "sma_25_above_75",
    "close_above_sma25",
    "rsi_14",
    "bb_width",
    "bb_position",
    "fundamental_score",
    "per_norm",
    "pbr_norm",
    "roe_norm",
    "dividend_yield",
    "volume_ma_ratio",
    "return_5d",
    "return_20d",
    "volatility_20d",
]

VOLUME_BARS = 20
LOOKBACK = 21

# Indicators of the training input.
TRAINING_SPEC = IndicatorSpec(sma=(5, 25, 75), cross=(25, 75))
FACTS = ["fundamental_score", "per", "pbr", "roe", "dividend_yield"]

# A training row must carry these beside ticker, Date and label.
INPUTS = [
    "Close", "Volume", "sma_5", "sma_25", "sma_75", "rsi_14", "bb_upper", "bb_lower",
    "fundamental_score", "per", "pbr", "roe", "dividend_yield",
]


def feature_matrix(rows: DataFrame, grid: BarGrid) -> DataFrame:
    """`ticker, Date`, the 17 features and `label`; incomplete rows are dropped."""
    spread = with_lookback(rows.select("ticker", "Date", *INPUTS, "label"), grid, LOOKBACK)
    df = select_features(spread, in_chunk(), "label").filter("is_core")
    return df.drop("is_core", CHUNK).dropna(how="any", subset=[*FEATURES, "label"])


def training_matrix(
    bars: DataFrame,
    fundamentals: DataFrame,
    grid: BarGrid,
    bars_ahead: int = 20,
    threshold: float = 0.03,
) -> DataFrame:
    """Feature matrix straight from bars and fundamentals, in one pass over the bars.

    The label of a bar is known `bars_ahead` bars later. So each bar gives the row
    of the bar that many before it, and no bars have to be copied from ahead.
    """
    w = in_chunk()
    spread = with_lookback(bars, grid, max(TRAINING_SPEC.lookback, LOOKBACK) + bars_ahead)
    facts = fundamentals.select("ticker", *[c for c in FACTS if c not in bars.columns])
    df = join_dimension(add_indicators(spread, TRAINING_SPEC, w), facts, "ticker")
    df = select_features(df, w, "Close")
    past = {c: F.lag(c, bars_ahead).over(w) for c in ["Date", "Close", *FEATURES]}
    df = df.select(
        "ticker", "is_core", F.col("Close").alias("_later"), *[c.alias(n) for n, c in past.items()]
    )
    gain = ratio(F.col("_later"), F.col("Close")) - 1
    return (
        df.filter("is_core")
        .select("ticker", "Date", *FEATURES, (gain >= threshold).cast("int").alias("label"))
        .dropna(how="any", subset=[*FEATURES, "label"])
    )


def select_features(df: DataFrame, w: WindowSpec, *keep: str) -> DataFrame:
    """Features of bars that carry a lookback, with their keys and `keep`."""
    close, volume = F.col("Close"), F.col("Volume")
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns(
        {
            "_return": ratio(close, F.lag("Close", 1).over(w)) - 1,
            "_volume": F.coalesce(F.sum("Volume").over(running), F.lit(0)),
            "_count": F.count("Volume").over(running),
        }
    )
    recent_volume = F.col("_volume") - F.coalesce(F.lag("_volume", VOLUME_BARS).over(w), F.lit(0))
    recent_count = F.col("_count") - F.coalesce(F.lag("_count", VOLUME_BARS).over(w), F.lit(0))
    mean_volume = ratio(recent_volume.cast("double"), recent_count.cast("double"))
    band = F.col("bb_upper") - F.col("bb_lower")
    df = df.withColumns(
        {
            "_volume_ratio": ratio(volume.cast("double"), mean_volume),
            "_return_5": ratio(close, F.lag("Close", 5).over(w)) - 1,
            "_return_20": ratio(close, F.lag("Close", 20).over(w)) - 1,
            "_volatility": rolling_volatility(w, "_return"),
        }
    )
    features = {
        "sma_5_ratio": ratio(F.col("sma_5"), close) - 1,
        "sma_25_ratio": ratio(F.col("sma_25"), close) - 1,
        "sma_75_ratio": ratio(F.col("sma_75"), close) - 1,
        "sma_25_above_75": flag(F.col("sma_25") > F.col("sma_75")),
        "close_above_sma25": flag(close > F.col("sma_25")),
        "rsi_14": F.col("rsi_14") / 100,
        "bb_width": ratio(band, close),
        "bb_position": ratio(close - F.col("bb_lower"), band),
        "fundamental_score": F.col("fundamental_score") / 100,
        "per_norm": clip(or_default(F.col("per"), 15.0) / 50, 0.0, 1.0),
        "pbr_norm": clip(or_default(F.col("pbr"), 1.5) / 10, 0.0, 1.0),
        "roe_norm": clip(or_default(F.col("roe"), 0.1), 0.0, 0.5) / 0.5,
        "dividend_yield": or_default(F.col("dividend_yield"), 0.0) * 100,
        "volume_ma_ratio": F.col("_volume_ratio"),
        "return_5d": F.col("_return_5"),
        "return_20d": F.col("_return_20"),
        "volatility_20d": F.col("_volatility"),
    }
    return df.select(
        "ticker", CHUNK, "Date", "is_core", *[features[f].alias(f) for f in FEATURES], *keep
    )


def split_by_position(rows: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Add `is_train`: the first share of the rows in order of (Date, ticker).

    No global sort: rows are counted per date, the counts are summed up by month
    and then within it, and the one date at the cut is split by ticker. `rows` is
    read several times, so pass a stored or checkpointed table.
    """
    month = F.floor(seconds_of(F.col("Date")) / (30 * 86_400))
    dates = rows.groupBy("Date").agg(F.count("*").alias("n")).withColumn("month", month)
    months = dates.groupBy("month").agg(F.sum("n").alias("month_rows"))
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select("month", F.sum("month_rows").over(before).alias("months_before"))
    within = Window.partitionBy("month").orderBy("Date").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce("months_before", F.lit(0)) + F.coalesce(F.sum("n").over(within), F.lit(0))
    dates = dates.join(months, "month").withColumn("start", start)

    wanted = rows.agg(F.floor(F.count("*") * F.lit(train_share)).alias("k")).scalar()
    cut = dates.filter((F.col("start") < wanted) & (wanted <= F.col("start") + F.col("n"))).select(
        F.col("Date").alias("cut_date"), (wanted - F.col("start")).alias("kept")
    )
    on_cut = rows.join(F.broadcast(cut), F.col("Date") == F.col("cut_date")).select(
        "Date", "ticker", "kept"
    )
    place = F.row_number().over(Window.partitionBy("Date").orderBy("ticker"))
    last = on_cut.withColumn("place", place).filter(F.col("place") == F.col("kept"))
    cut_date = cut.select("cut_date").scalar()
    cut_ticker = last.select("ticker").scalar()
    # Without a cut (no training row at all) both are null, and so is the test.
    early = F.col("Date") < cut_date
    same = (F.col("Date") == cut_date) & (F.col("ticker") <= cut_ticker)
    return rows.withColumn("is_train", F.coalesce(early | same, F.lit(False)))


def class_weight(train: DataFrame) -> DataFrame:
    """One row: negatives, positives and negatives per positive."""
    positive, negative = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    return train.agg(
        negative.alias("negatives"),
        positive.alias("positives"),
        (negative / F.greatest(positive, F.lit(1))).alias("scale_pos_weight"),
    )
