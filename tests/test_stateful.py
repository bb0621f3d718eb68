"""Keyed state with timers against the batch fold, for bars in any order and with restarts."""

from __future__ import annotations

import random

from conftest import day
from pyspark.sql import functions as F

from tickloom.operators.chunks import BarGrid
from tickloom.operators.positions import TradeRules, equity_curve, replay, trades
from tickloom.streaming.bars import first_in_time
from tickloom.streaming.stateful import closed_trades, positions_in_time, rocksdb

SCHEMA = "ticker string, Date timestamp_ntz, Close double, decision string"
RULES = TradeRules(holding_period=5)


def signals(spark, n=40):
    rng = random.Random(3)
    return [
        (t, day(i), float(rng.randrange(50, 150)), rng.choice(["BUY", "HOLD", "SELL"]))
        for t in ("A", "B")
        for i in range(n)
    ]


def run(spark, folder, out):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    with rocksdb(spark):
        positions_in_time(stream, RULES, "5 days").writeStream.format("parquet").option(
            "checkpointLocation", f"{folder}/progress"
        ).trigger(availableNow=True).start(out).awaitTermination()


def test_stream_equals_batch_out_of_order_and_restarted(spark, tmp_path):
    rows = signals(spark)
    rng = random.Random(4)
    # within four days any order, some bars twice (the second one dearer)
    moved = sorted(rows, key=lambda r: (r[1] - day(0)).days + rng.uniform(0, 4))
    moved = [x for r in moved for x in ([r, (*r[:2], r[2] + 500, "BUY")] if rng.random() < 0.2 else [r])]
    moved += [("C", None, 1.0, "BUY"), (None, day(3), 1.0, "BUY"), ("C", day(39), None, "BUY")]
    size = -(-len(moved) // 4)
    for i in range(4):
        part = spark.createDataFrame(moved[i * size : (i + 1) * size], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if i in (1, 3):  # the stream is stopped in between
            run(spark, tmp_path, f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out")
    whole = replay(spark.createDataFrame(rows, SCHEMA), BarGrid(86_400, 7), RULES)
    seen = got.agg(F.max("Date")).first()[0]
    assert seen >= day(33)
    curve = equity_curve(whole).filter(F.col("date") <= F.lit(seen))
    assert sorted(map(tuple, curve.collect())) == sorted(
        map(tuple, got.select("ticker", "Date", "portfolio_value", "Close", "decision", "in_position").collect())
    )
    columns = ["ticker", "entry_date", "entry_price", "exit_date", "exit_price", "holding_days", "exit_reason"]
    closed = trades(whole).filter(F.col("exit_reason") != "end_of_data").filter(F.col("exit_date") <= F.lit(seen))
    mine = closed_trades(got)
    assert sorted(map(tuple, mine.select(columns).collect())) == sorted(map(tuple, closed.select(columns).collect()))
    assert closed.count() > 5


def test_first_bar_stays_for_any_order_of_files(spark, tmp_path):
    schema = "ticker string, Date timestamp_ntz, Close double, message int"
    rows = [(t, day(i), float(10 * m + i), m) for t in "AB" for i in range(20) for m in (1, 2, 3)]
    found = []
    for seed in range(2):
        mixed = sorted(rows, key=lambda r: (r[1] - day(0)).days + random.Random(f"{seed}{r}").uniform(0, 3))
        folder = f"{tmp_path}/{seed}"
        for i in range(0, len(mixed), 30):
            part = spark.createDataFrame(mixed[i : i + 30], schema)
            part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        out = first_in_time(stream, F.col("message"), "4 days").writeStream.format("parquet")
        out = out.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True)
        out.start(f"{folder}/out").awaitTermination()
        found.append(sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect())))
    assert found[0] == found[1]
    assert found[0] == sorted(r for r in rows if r[3] == 1 and r[1] <= day(15))
