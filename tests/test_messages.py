from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tickloom.operators.chunks import DAILY, BarGrid
from tickloom.operators.messages import (
    add_envelope,
    build_messages,
    flatten_messages,
    message_stats,
    parse_messages,
    publish_stats,
    rejected_messages,
    spread,
    validate_messages,
)
from tickloom.sinks.writers import publish, write_message_files
from tickloom.streaming.bars import current_rows, evaluate_stream, first_bars, stream_bars, with_open_bars
from tickloom.streaming.consume import drain_messages, read_message_files, stored_stats
from tickloom.operators.decisions import evaluate
from checks.inputs import hourly_bars, table

BAR = {"Date": "2024-01-01T00:00:00.000", "Open": 1, "High": 2, "Low": 1, "Close": 1.5, "Volume": 10}


def bar(**changes):
    return {k: v for k, v in {**BAR, **changes}.items() if v != "absent"}


def message(*bars, **fields):
    return json.dumps({"ticker": "X", "ohlcv": list(bars), **fields})


CASES = {
    "good": (message(bar()), []),
    "null ticker": (message(bar(), ticker=None), []),
    "no ticker": (json.dumps({"ohlcv": [bar()]}), ["missing_ticker"]),
    "no bars": (json.dumps({"ticker": "X"}), ["missing_ohlcv"]),
    "null bars": (json.dumps({"ticker": "X", "ohlcv": None}), ["missing_ohlcv"]),
    "empty list": (message(), ["missing_ohlcv"]),
    "empty object": (json.dumps({"ticker": "X", "ohlcv": {}}), ["missing_ohlcv"]),
    "empty text": (json.dumps({"ticker": "X", "ohlcv": ""}), ["missing_ohlcv"]),
    "zero": (json.dumps({"ticker": "X", "ohlcv": 0}), ["missing_ohlcv"]),
    "text zero": (json.dumps({"ticker": "X", "ohlcv": "0"}), ["ohlcv_not_a_list"]),
    "object": (json.dumps({"ticker": "X", "ohlcv": {"a": 1}}), ["ohlcv_not_a_list"]),
    "first lacks fields": (message(bar(Open="absent", Volume="absent")), ["missing_field:Open", "missing_field:Volume"]),
    "later lacks fields": (message(bar(), bar(Open="absent", Date="2024-01-02")), []),
    "close 0": (message(bar(Close=0)), ["invalid_close:Close"]),
    "close absent": (message(bar(Close="absent")), ["missing_field:Close", "invalid_close:Close"]),
    "close null": (message(bar(Close=None)), ["type_error:Close"]),
    "close text": (message(bar(Close="abc")), ["type_error:Close"]),
    "close number as text": (message(bar(Close="1.5")), []),
    "close suffix": (message(bar(Close="1.5d")), ["type_error:Close"]),
    "close underscore": (message(bar(Close="1_0.5")), []),
    "close list": (message(bar(Close=[1])), ["type_error:Close"]),
    "close true": (message(bar(Close=True)), []),
    "close NaN": (message(bar(Close=float("nan"))), []),
    "volume -1": (message(bar(Volume=-1)), ["negative_volume:Volume"]),
    "volume text": (message(bar(Volume="12")), []),
    "volume text fraction": (message(bar(Volume="12.7")), ["type_error:Volume"]),
    "volume fraction": (message(bar(Volume=12.7)), []),
    "volume -0.5": (message(bar(Volume=-0.5)), []),
    "volume NaN": (message(bar(Volume=float("nan"))), ["type_error:Volume"]),
    "high below low": (message(bar(High=0.5)), ["high_below_low:High"]),
    "cast hides high below low": (message(bar(High=0.5, Volume=None)), ["type_error:Volume"]),
    "price and cast": (message(bar(Close=-1, Volume="x")), ["invalid_close:Close", "type_error:Volume"]),
    "low text": (message(bar(Low="x")), ["type_error:Low"]),
    "bar is a number": (message(5), ["type_error:None"]),
    "bad date": (message(bar(Date="some day")), ["type_error:Date"]),
    "bad later date": (message(bar(), bar(Date="2024-13-01")), ["type_error:Date"]),
    "broken": ("{bad", ["broken_json"]),
    "list": ("[1]", ["not_an_object"]),
}


@pytest.fixture(scope="module")
def checked(spark):
    rows = [(name, text) for name, (text, _) in CASES.items()]
    df = spark.createDataFrame(rows, "name string, value string")
    return validate_messages(parse_messages(df))


def test_rules(checked):
    for row in checked.select("name", "errors", "is_valid").collect():
        got = [e.code if e.row_index is None else f"{e.code}:{e.field}" for e in row.errors]
        assert (row.name, got) == (row.name, CASES[row.name][1])
        assert row.is_valid == (not got)


def test_stats_and_rejects(checked):
    valid = sum(not errors for _, errors in CASES.values())
    stats = message_stats(checked).first()
    assert (stats.received, stats.valid, stats.invalid) == (len(CASES), valid, len(CASES) - valid)
    assert stats.validation_rate == f"{valid / len(CASES) * 100:.1f}%"
    assert rejected_messages(checked).count() == stats.invalid
    empty = message_stats(checked.filter("name = 'none'")).first()
    assert empty.validation_rate == "0.0%"


def test_flatten_keeps_first_of_a_date_and_spreads_fundamentals(spark):
    facts = {"per": 12.5, "sector": "ignored", "ticker": "Y"}
    rows = [
        ("a", message(bar(), bar(Close=9), bar(Date="2024-01-02"), fundamentals=[facts], company_name="C")),
        ("b", message(bar(Open="absent", Date="2024-01-03"), bar(), fundamentals=facts, sector="S").replace("X", "Z")),
        ("c", message(bar(), fundamentals=[]).replace("X", "W")),
    ]
    df = validate_messages(parse_messages(spark.createDataFrame(rows, "id string, value string")))
    got = {(r.id, r.Date.day): r for r in flatten_messages(df, "id").collect()}
    assert sorted(got) == [("a", 1), ("a", 2), ("c", 1)]  # b lacks a field in its first bar
    assert got["a", 1].Close == 1.5 and got["a", 1].Volume == 10
    assert (got["a", 1].per, got["a", 1].company_name, got["a", 1].sector) == (12.5, "C", "Unknown")
    assert (got["c", 1].ticker, got["c", 1].per, got["c", 1].company_name) == ("W", None, "W")


def test_long_tickers_come_in_parts(spark, series):
    bars = series(T=[float(i + 1) for i in range(10)])
    parts = build_messages(bars, BarGrid(86_400, 4)).collect()
    assert len(parts) >= 3
    sizes = [json.loads(p.value)["metadata"]["rows"] for p in parts]
    assert sum(sizes) == 10 and max(sizes) <= 4
    whole = json.loads(build_messages(bars, DAILY).first().value)
    assert [b["Close"] for b in whole["ohlcv"]] == [float(i + 1) for i in range(10)]
    assert whole["fundamentals"] == {} and whole["sector"] == "Unknown"


def test_envelope(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{}",)], "value string")
    for row in add_envelope(df, F.lit("now")).collect():
        meta = json.loads(row.value)["publish_metadata"]
        assert meta == {"published_at": "now", "source": "yfinance", "schema_version": "1.0"}


def test_files_publish_and_stream_equal_batch(spark, sf, tmp_path):
    bars = hourly_bars(spark, sf)
    built = build_messages(bars, BarGrid(3_600, 200))
    write_message_files(built, f"{tmp_path}/messages")
    broken = [("bad", 0, "{broken")]
    extra = spark.createDataFrame(broken, "ticker string, part bigint, value string")
    write_message_files(extra, f"{tmp_path}/more")
    files = f"{tmp_path}/m*/*/*"
    batch = validate_messages(parse_messages(read_message_files(spark, files, "*.txt")))
    expected = sorted(map(str, flatten_messages(batch).collect()))
    assert len(expected) == bars.count()
    for _ in range(2):  # the second run finds nothing new
        drain_messages(spark, files, f"{tmp_path}/out", f"{tmp_path}/progress", files_per_batch=8)
    streamed = spark.read.parquet(f"{tmp_path}/out/valid").drop("file", "batch")
    assert sorted(map(str, streamed.collect())) == expected
    assert spark.read.parquet(f"{tmp_path}/out/valid").select("batch").distinct().count() > 1
    assert str(stored_stats(spark, f"{tmp_path}/out").first()) == str(message_stats(batch).first())
    assert spark.read.parquet(f"{tmp_path}/out/rejected").first().errors[0].code == "broken_json"
    for _ in range(2):  # a batch that is published again replaces itself
        sent = publish(built.unionByName(extra), f"{tmp_path}/queue", "first")
    stats = publish_stats(sent).first()
    assert (stats.messages_sent, stats.errors) == (built.count(), 1)
    assert spark.read.parquet(f"{tmp_path}/queue").count() == built.count()


def test_streamed_evaluation_equals_batch_even_with_late_bars(spark, sf, tmp_path):
    grid = BarGrid(3_600, 40)
    bars = hourly_bars(spark, sf).filter("ticker IN ('click', 'error')")
    # Five files, the fourth of which holds bars from the middle of the period.
    hour = F.floor(F.hour("Date") / 6)
    split = F.when(F.dayofmonth("Date") == 15, 3).when(F.dayofmonth("Date") > 20, 4).otherwise(hour % 3)
    for n in range(5):
        bars.filter(split == n).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    evaluate_stream(spark, stream, f"{tmp_path}/state", grid).awaitTermination()
    streamed = current_rows(spark, f"{tmp_path}/state")
    expected = evaluate(bars, grid)
    assert sorted(map(str, streamed.select(expected.columns).collect())) == sorted(
        map(str, expected.collect())
    )


def test_stream_of_rows_to_bars(spark, sf, tmp_path):
    events = table(spark, sf, "events")
    for week in range(5):  # files in order of time
        part = events.filter(F.floor(F.dayofmonth("ts") / 7) == week)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    stream = stream.parquet(f"{tmp_path}/events")
    built = stream_bars(stream, F.col("event_type"), F.col("ts"), F.col("value"))
    query = (
        built.writeStream.option("checkpointLocation", f"{tmp_path}/progress")
        .trigger(availableNow=True)
        .format("parquet")
        .start(f"{tmp_path}/bars")
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/bars")
    # Windows younger than the watermark stay open: rows may still come for them.
    newest = got.agg(F.max("Date")).first()[0]
    expected = hourly_bars(spark, sf).filter(F.col("Date") <= F.lit(newest)).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert got.count() > 500
    whole = with_open_bars(got, events, F.col("event_type"), F.col("ts"), F.col("value"))
    every = hourly_bars(spark, sf).select(whole.columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, every.collect()))


def test_repeats_across_files_are_dropped(spark, sf, tmp_path):
    bars = hourly_bars(spark, sf).filter("ticker = 'click'")
    for _ in range(2):
        bars.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(bars.schema).parquet(f"{tmp_path}/in")
    query = (
        first_bars(stream, "60 days")
        .writeStream.option("checkpointLocation", f"{tmp_path}/progress")
        .trigger(availableNow=True)
        .format("parquet")
        .start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(map(str, got)) == sorted(map(str, bars.collect()))


def test_keys_that_nobody_named_are_kept(spark):
    values = [
        message(bar(Volume=12.7, note="x", deep={"a": [1]}, on=True), bar(Date="2024-01-02", n=3, on=False)),
        message(bar(Date="2024-01-03", n=2.5, mixed=1), fundamentals={"per": 3, "beta": 1.5, "ticker": "Z"}),
        message(bar(Date="2024-01-04", Volume=10**25, mixed="one"), fundamentals=[{"beta": 2}]),
    ]
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    flat = flatten_messages(validate_messages(parse_messages(raw)), others=True)
    got = {r["Date"].day: r for r in flat.collect()}
    assert got[1]["Volume"] == 12 and float(got[1]["other_bar"]["Volume"]) == 12.7
    assert got[1]["other_bar"]["deep"] == '{"a":[1]}' and got[2]["other_bar"] == {"n": "3", "on": "false"}
    assert got[3]["other_fundamentals"] == {"beta": "1.5"} and got[1]["other_fundamentals"] == {}
    assert float(got[4]["other_bar"]["Volume"]) == 1e25
    wide = spread(spread(flat.drop("Volume"), "other_bar"), "other_fundamentals")
    kinds = dict(wide.dtypes)
    assert kinds["on"] == "boolean" and kinds["note"] == kinds["deep"] == kinds["mixed"] == "string"
    rows = {r["Date"].day: r for r in wide.collect()}
    assert (rows[2]["n"], rows[3]["n"], rows[1]["n"]) == (3.0, 2.5, None)
    assert (rows[3]["beta"], rows[4]["beta"], rows[1]["beta"]) == (1.5, 2.0, None)
    assert rows[1]["Volume"] == 12.7 and rows[3]["per"] == 3.0
