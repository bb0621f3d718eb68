"""Cutting long tickers into chunks that fit one task.

Bars lie on a time grid and are unique on (ticker, Date), so a span of
`chunk_bars` grid steps holds at most `chunk_bars` bars of a ticker. The chunk
of a bar is a plain expression of its date. A ticker that holds a third of the
table is thus spread over as many tasks as it has chunks:

* bounded windows run per (ticker, chunk) after `with_lookback` has copied the
  last few bars before each chunk into it;
* unbounded windows run per (ticker, chunk) on top of `carried` values, the
  running totals of all earlier chunks.

Both give exactly what one window over the whole ticker gives.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.columns import seconds_of

CHUNK = "chunk"


@dataclass(frozen=True)
class BarGrid:
    """Distance of neighbouring bars and the number of grid steps per chunk."""

    seconds: int
    chunk_bars: int = 50_000

    def chunk(self, date: str = "Date") -> Column:
        return F.floor(seconds_of(F.col(date)) / (self.seconds * self.chunk_bars))

    def chunk_since(self, date: str = "Date") -> Column:
        """Start of the bar's chunk as text that sorts like time."""
        start = self.chunk(date) * (self.seconds * self.chunk_bars)
        epoch = F.expr("timestamp_ntz'1970-01-01'")
        return F.date_format(epoch + F.make_dt_interval(secs=start), "yyyyMMdd'T'HHmmss")


DAILY = BarGrid(86_400)
HOURLY = BarGrid(3_600)
MINUTES = BarGrid(60)


def in_chunk(*keys: str, date: str = "Date") -> WindowSpec:
    return Window.partitionBy(*(keys or ("ticker",)), CHUNK).orderBy(date)


def with_lookback(
    bars: DataFrame,
    grid: BarGrid,
    rows: int,
    keys: Sequence[str] = ("ticker",),
    ahead: int = 0,
) -> DataFrame:
    """Bars with `chunk` and `is_core`, plus copies of the `rows` bars before each chunk.

    Copies have `is_core = false`; drop them once the windows are computed. With
    `ahead` the first bars after each chunk are copied into it as well.
    """
    core = bars.withColumn(CHUNK, grid.chunk())
    spread = core.withColumn("is_core", F.lit(True))
    if rows:
        spread = spread.unionByName(_copies(core, rows, list(keys), F.desc, F.asc))
    if ahead:
        spread = spread.unionByName(_copies(core, ahead, list(keys), F.asc, F.desc))
    return spread


def _copies(core: DataFrame, rows: int, keys: list[str], nearest, onward) -> DataFrame:
    """The `rows` bars at the edge of every chunk, once per later chunk that needs them.

    Chunks may be sparse, so a copy can go any number of chunks on.
    """
    edge = Window.partitionBy(*keys, CHUNK).orderBy(nearest("Date"))
    tails = core.withColumn("_age", F.row_number().over(edge)).filter(F.col("_age") <= rows)
    # One row per chunk: rows it offers, offers of the chunks passed before it,
    # and the next chunks close enough to still need some of its rows.
    # The hash makes this branch read the columns the others read, so that Spark
    # sees one exchange of the bars and does not build them a second time.
    widest = F.max(F.struct("_age", F.xxhash64(*[F.col(c) for c in core.columns])))
    sizes = tails.groupBy(*keys, CHUNK).agg(widest["_age"].alias("_offered"))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(onward(CHUNK))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    near = Window.partitionBy(*keys).orderBy("_before").rangeBetween(1, 2 * rows - 1)
    feeds = sizes.withColumn(
        "_before", F.coalesce(F.sum("_offered").over(earlier), F.lit(0))
    ).select(
        *keys,
        CHUNK,
        (F.col("_before") + F.col("_offered")).alias("_end"),
        F.collect_list(F.struct(F.col(CHUNK).alias("chunk"), F.col("_before").alias("at")))
        .over(near)
        .alias("_later"),
    )
    reached = F.filter(
        "_later", lambda later: later["at"] - F.col("_end") + F.col("_age") <= rows
    )
    values = [c for c in core.columns if c != CHUNK]
    # A left join on null-safe keys: others would add null checks below a side and
    # keep Spark from reusing the exchange that builds the bars.
    named = feeds.withColumnsRenamed({k: f"_{k}_of" for k in [*keys, CHUNK]})
    same = [tails[k].eqNullSafe(named[f"_{k}_of"]) for k in [*keys, CHUNK]]
    return (
        tails.join(named, same, "left")
        .select(*values, F.explode(reached).alias("_to"))
        .select(*values, F.col("_to.chunk").alias(CHUNK), F.lit(False).alias("is_core"))
    )


def carried(
    df: DataFrame,
    totals: Mapping[str, Column],
    running: Mapping[str, Column],
    keys: Sequence[str] = ("ticker",),
) -> DataFrame:
    """Join the running totals of all earlier chunks onto every row.

    `totals` are aggregates per (keys, chunk); `running` are aggregates of those
    over the earlier chunks. The first chunk of a ticker gets nulls.
    """
    keys = list(keys)
    earlier = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = df.groupBy(*keys, CHUNK).agg(*[c.alias(name) for name, c in totals.items()])
    before = sums.select(
        *keys, CHUNK, *[c.over(earlier).alias(name) for name, c in running.items()]
    )
    return df.join(before, [*keys, CHUNK], "left")


def recent(
    bars: DataFrame, rows: int, grid: BarGrid, keys: Sequence[str] = ("ticker",)
) -> DataFrame:
    """The last `rows` bars per ticker.

    Bars are counted per chunk first, so only the newest chunks that hold `rows`
    bars are ranked, however long the history is.
    """
    keys = list(keys)
    later = Window.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    core = bars.withColumn(CHUNK, grid.chunk())
    counts = core.groupBy(*keys, CHUNK).agg(F.count("*").alias("_bars"))
    near = counts.withColumn("_later", F.coalesce(F.sum("_bars").over(later), F.lit(0)))
    needed = near.filter(F.col("_later") < rows).select(*keys, CHUNK)
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("Date"))
    return (
        core.join(needed, [*keys, CHUNK], "left_semi")
        .withColumn("_age", F.row_number().over(newest_first))
        .filter(F.col("_age") <= rows)
        .select(*bars.columns)
    )
