"""Technical indicators over price bars.

Two warm-up rules exist for every rolling value: `partial` averages what there
is from the first bar on, `full` stays null until the window is filled. Rolling
means come from differences of running decimal sums, so their cost does not
depend on the window's length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.columns import exact, exact_ratio, ratio, steady_round
from tickloom.operators.chunks import CHUNK, BarGrid, in_chunk, with_lookback


@dataclass(frozen=True)
class IndicatorSpec:
    sma: tuple[int, ...] = (5, 20, 50, 200)
    cross: tuple[int, int] = (20, 50)
    rsi: int = 14
    bands: int = 20
    band_width: float = 2.0
    full_windows: bool = False  # null until the window is filled
    round_band_std: bool = True  # round the deviation before the bands are drawn
    rsi_floor: float | None = 0.001  # stands in for a mean loss of zero
    rounded: bool = True

    @property
    def lookback(self) -> int:
        """Earlier bars a bar's values depend on."""
        return max(*self.sma, *self.cross, self.rsi, self.bands, 1) + 1


PARTIAL = IndicatorSpec()
FULL = IndicatorSpec(full_windows=True, round_band_std=False)
UNGUARDED = replace(FULL, rsi_floor=None, rounded=False)


def _last(running: str, n: int, w: WindowSpec) -> Column:
    """Sum over the last n rows, from a running sum."""
    return F.col(running) - F.coalesce(F.lag(running, n).over(w), F.lit(0))


def rolling_mean(n: int, w: WindowSpec, full: bool, total: str = "_sum", seen: str = "_seen") -> Column:
    """Mean of the non-null values among the last n rows, a decimal."""
    count = _last(seen, n, w)
    mean = exact_ratio(_last(total, n, w), count)
    return F.when(count >= (n if full else 1), mean)


def relative_strength(gain: Column, loss: Column, rows: Column, floor: float | None) -> Column:
    """100 - 100 / (1 + mean gain / mean loss), from sums over the same `rows` bars."""
    gain, loss = gain.cast("double"), loss.cast("double")
    if floor is None:
        strength = ratio(gain, loss)
        return F.when((loss == 0) & (gain > 0), F.lit(100.0)).otherwise(
            100.0 - 100.0 / (1.0 + strength)
        )
    mean_loss = F.when(loss == 0, F.lit(floor)).otherwise(loss / rows)
    return 100.0 - 100.0 / (1.0 + gain / rows / mean_loss)


def add_indicators(df: DataFrame, spec: IndicatorSpec, w: WindowSpec) -> DataFrame:
    """Add all indicator columns; every window shares `w`, hence one shuffle and sort."""
    shown = steady_round if spec.rounded else (lambda value: value.cast("double"))
    close = F.col("Close")
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    step = F.col("_exact") - F.lag("_exact", 1).over(w)

    df = df.withColumn("_exact", exact(close)).withColumn("_step", step)
    gain = F.when(F.col("_step") > 0, F.col("_step")).otherwise(0)
    loss = F.when(F.col("_step") < 0, -F.col("_step")).otherwise(0)
    df = df.withColumns(
        {
            "_sum": F.coalesce(F.sum("_exact").over(running), F.lit(0)),
            "_seen": F.count("_exact").over(running),
            "_gains": F.sum(gain).over(running),
            "_losses": F.sum(loss).over(running),
            "_row": F.row_number().over(w),
            "_std": F.stddev_samp("Close").over(w.rowsBetween(1 - spec.bands, 0)),
            "_prev": F.lag("Close", 1).over(w),
        }
    )

    means = sorted({*spec.sma, *spec.cross, spec.bands})
    df = df.withColumns(
        {f"_sma_{n}": shown(rolling_mean(n, w, spec.full_windows)) for n in means}
        | {
            "_gain_n": _last("_gains", spec.rsi, w),
            "_loss_n": _last("_losses", spec.rsi, w),
            "_seen_n": _last("_seen", spec.bands, w),
        }
    )

    fast, slow = (F.col(f"_sma_{n}") for n in spec.cross)
    prev_fast, prev_slow = (F.lag(f"_sma_{n}", 1).over(w) for n in spec.cross)
    rows = F.least(F.col("_row"), F.lit(spec.rsi))
    strength = relative_strength(F.col("_gain_n"), F.col("_loss_n"), rows, spec.rsi_floor)
    if spec.full_windows:
        strength = F.when(rows == spec.rsi, strength)
    std = F.col("_std")
    if spec.full_windows:
        std = F.when(F.col("_seen_n") >= spec.bands, std)
    if spec.round_band_std:
        std = steady_round(std)
    middle = F.col(f"_sma_{spec.bands}")
    change = (close - F.col("_prev")) * 100
    df = df.withColumns(
        {f"sma_{n}": F.col(f"_sma_{n}") for n in spec.sma}
        | {
            "golden_cross": F.coalesce((fast > slow) & (prev_fast <= prev_slow), F.lit(False)),
            "dead_cross": F.coalesce((fast < slow) & (prev_fast >= prev_slow), F.lit(False)),
            f"rsi_{spec.rsi}": shown(strength),
            "bb_upper": shown(middle + spec.band_width * std),
            "bb_lower": shown(middle - spec.band_width * std),
            "daily_return_pct": shown(ratio(change, F.col("_prev"))),
        }
    )
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def indicators(bars: DataFrame, grid: BarGrid, spec: IndicatorSpec = PARTIAL) -> DataFrame:
    """All indicators for every bar of every ticker."""
    spread = with_lookback(bars, grid, spec.lookback)
    return (
        add_indicators(spread, spec, in_chunk()).filter("is_core").drop(CHUNK, "is_core")
    )


def moving_averages(
    bars: DataFrame,
    grid: BarGrid,
    periods: Sequence[int],
    full: bool = False,
    places: int | None = 2,
) -> DataFrame:
    """`sma_<n>` for each period, rounded unless `places` is None."""
    w = in_chunk()
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    df = with_lookback(bars, grid, max(periods))
    df = df.withColumn("_exact", exact(F.col("Close"))).withColumns(
        {
            "_sum": F.coalesce(F.sum("_exact").over(running), F.lit(0)),
            "_seen": F.count("_exact").over(running),
        }
    )
    mean = {n: rolling_mean(n, w, full) for n in periods}
    df = df.withColumns(
        {
            f"sma_{n}": m.cast("double") if places is None else steady_round(m, places)
            for n, m in mean.items()
        }
    )
    return df.filter("is_core").drop("_exact", "_sum", "_seen", CHUNK, "is_core")


def price_changes(bars: DataFrame, grid: BarGrid, lags: Sequence[int] = (1, 5, 20)) -> DataFrame:
    """`return_<k>`: relative change against k bars before, unrounded."""
    w = in_chunk()
    df = with_lookback(bars, grid, max(lags)).withColumns(
        {f"return_{k}": ratio(F.col("Close"), F.lag("Close", k).over(w)) - 1 for k in lags}
    )
    return df.filter("is_core").drop(CHUNK, "is_core")


def forward_label(
    bars: DataFrame, grid: BarGrid, bars_ahead: int = 20, threshold: float = 0.03
) -> DataFrame:
    """`label` = 1 if the close `bars_ahead` bars later is up by the threshold.

    Null where the ticker has no such later bar.
    """
    df = add_label(with_lookback(bars, grid, 0, ahead=bars_ahead), in_chunk(), bars_ahead, threshold)
    return df.filter("is_core").drop(CHUNK, "is_core")


def add_label(df: DataFrame, w: WindowSpec, bars_ahead: int, threshold: float) -> DataFrame:
    gain = ratio(F.lead("Close", bars_ahead).over(w), F.col("Close")) - 1
    return df.withColumn("label", (gain >= threshold).cast("int"))


def rolling_volatility(w: WindowSpec, returns: str, n: int = 20) -> Column:
    """Sample deviation of the last n returns; null until there are n."""
    last = w.rowsBetween(1 - n, 0)
    return F.when(F.count(returns).over(last) == n, F.stddev_samp(returns).over(last))
