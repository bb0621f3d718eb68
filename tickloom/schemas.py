"""Column layouts of the library's tables."""

from __future__ import annotations

from pyspark.sql import types as T

BAR_FIELDS = ["Date", "Open", "High", "Low", "Close", "Volume"]

# A price bar: unique on (ticker, Date).
BARS = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("Date", T.TimestampNTZType(), False),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)

# Raw bar table: bars with the fundamentals repeated on every row.
RAW_BARS = T.StructType(
    BARS.fields
    + [
        T.StructField("dividend_yield", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("pe_ratio", T.DoubleType()),
        T.StructField("sector", T.StringType()),
        T.StructField("company_name", T.StringType()),
    ]
)

FUNDAMENTAL_VALUES = [
    "per",
    "pbr",
    "roe",
    "market_cap",
    "dividend_yield",
    "forward_pe",
    "enterprise_value",
    "profit_margins",
    "revenue_growth",
]

# One row per ticker.
FUNDAMENTALS = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("company_name", T.StringType()),
        T.StructField("sector", T.StringType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in FUNDAMENTAL_VALUES]
)

TICKERS = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("sector", T.StringType()),
    ]
)

# Input of the position fold.
SIGNALS = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("Date", T.TimestampNTZType(), False),
        T.StructField("Close", T.DoubleType()),
        T.StructField("decision", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)

TRADE = T.StructType(
    [
        T.StructField("entry_date", T.TimestampNTZType()),
        T.StructField("entry_price", T.DoubleType()),
        T.StructField("exit_date", T.TimestampNTZType()),
        T.StructField("exit_price", T.DoubleType()),
        T.StructField("holding_days", T.LongType()),
        T.StructField("pnl", T.DoubleType()),
        T.StructField("pnl_pct", T.DoubleType()),
        T.StructField("exit_reason", T.StringType()),
    ]
)

# Training input: indicators, fundamentals and the label of one bar.
TRAINING = T.StructType(
    BARS.fields
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "sma_5", "sma_25", "sma_75", "rsi_14", "bb_upper", "bb_lower",
            "fundamental_score", "per", "pbr", "roe", "dividend_yield",
        )
    ]
    + [T.StructField("label", T.IntegerType())]
)

# Row of the serving table.
SERVING = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("ticker", T.StringType()),
        T.StructField("companyName", T.StringType()),
        T.StructField("decisionDate", T.DateType()),
        T.StructField("decisionType", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("closePrice", T.DecimalType(18, 2)),
        T.StructField("rsi14", T.DoubleType()),
        T.StructField("fundamentalScore", T.DoubleType()),
    ]
)
