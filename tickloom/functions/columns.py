"""Column expressions shared by the operators. All stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prices are summed as decimals, so that sums are exact and do not depend on the
# order of the rows. Room: 18 places, and sums below 10^20; beyond it Spark fails.
EXACT = "decimal(38,18)"

# Dividend tier names.
TIER_HIGH = "高配当(4%+)"
TIER_MID = "中配当(2-4%)"
TIER_LOW = "低配当(<2%)"
TIER_NONE = "無配当"

# Decision vocabulary with its strength.
STRENGTH = {
    "BUY": 8,
    "SELL": 8,
    "OVERSOLD": 7,
    "OVERBOUGHT": 7,
    "BUY_BB": 6,
    "SELL_BB": 6,
    "HOLD": 3,
}


def exact(price: Column) -> Column:
    return price.cast(EXACT)


def exact_ratio(total: Column, count: Column) -> Column:
    """A decimal sum divided once, half up in the 18th place; null for no rows."""
    return total / F.nullif(count, F.lit(0)).cast("decimal(19,0)")


def steady_round(value: Column, places: int = 2) -> Column:
    """Half-up rounding of the number as written, as a double.

    `+ 0.0` turns a negative zero into zero.
    """
    return F.round(value, places).cast("double") + F.lit(0.0)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that is null, not an error, for a zero divisor."""
    return top / F.nullif(bottom, F.lit(0).cast("double"))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def flag(condition: Column) -> Column:
    """1 or 0; an unknown comparison counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def json_safe(value: Column, places: int = 2) -> Column:
    """Null, NaN and infinities become 0.0, everything else is rounded."""
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(value.isNull() | F.isnan(value) | infinite, F.lit(0.0)).otherwise(
        steady_round(value, places)
    )


def safe_name(ticker: Column) -> Column:
    """Ticker as used in folder and file names."""
    return F.replace(ticker, F.lit("."), F.lit("_"))


def percent_text(part: Column, whole: Column) -> Column:
    """`part / whole` as `12.3%`; an empty whole counts as 1."""
    return F.format_string("%.1f%%", part * 100.0 / F.greatest(whole, F.lit(1)))


def day_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def dividend_tier(dividend_yield: Column) -> Column:
    return (
        F.when(dividend_yield >= 0.04, TIER_HIGH)
        .when(dividend_yield >= 0.02, TIER_MID)
        .when(dividend_yield > 0, TIER_LOW)
        .otherwise(TIER_NONE)
    )


def decision_strength(decision: Column) -> Column:
    weakest = STRENGTH["HOLD"]
    strength = F.create_map(*[F.lit(x) for pair in STRENGTH.items() for x in pair])
    return F.coalesce(F.try_element_at(strength, decision), F.lit(weakest))


def utc_naive(instant: Column) -> Column:
    """Instant as UTC wall-clock time without a zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def local_naive(instant: Column, zone: Column) -> Column:
    """Instant as the market's own wall-clock time without a zone."""
    return F.convert_timezone(F.current_timezone(), zone, instant.cast("timestamp_ntz"))


def hour_of(ts: Column) -> Column:
    """Start of the hour, free of the session zone."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def seconds_of(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp."""
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)
