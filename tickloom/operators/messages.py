"""Nested JSON messages of bars: build, wrap, parse, validate, flatten, count.

Parsing, validation and flattening are narrow, so the same functions serve
batch tables and streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import percent_text
from tickloom.operators.chunks import CHUNK, BarGrid
from tickloom.schemas import BAR_FIELDS, FUNDAMENTAL_VALUES
from tickloom.sources.tables import describe_tickers, join_dimension

# Publish envelope.
SOURCE = "yfinance"
SCHEMA_VERSION = "1.0"

# Fields every message's first bar must have, in order of the report.
REQUIRED = ["Close", "Date", "High", "Low", "Open", "Volume"]

# Fields of a bar that are numbers.
NUMBERS = ["Open", "High", "Low", "Close", "Volume"]

ERRORS = "array<struct<code:string,row_index:int,field:string,value:string>>"

FLOAT_TEXT = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
FLOAT_WORD = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
INT_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"


def build_messages(
    bars: DataFrame,
    grid: BarGrid,
    tickers: DataFrame | None = None,
    fundamentals: DataFrame | None = None,
    fetched_at: Column | None = None,
) -> DataFrame:
    """`ticker, part, value`: one JSON message per ticker and chunk of its bars.

    A ticker's history is one message as long as it fits into a chunk; longer
    ones come in parts, so that no message grows without bound.
    """
    fields = [c for c in bars.columns if c != "ticker"]
    first, rest = "Date", [c for c in fields if c != "Date"]
    bar = F.struct(first, *rest, "ticker")
    df = (
        bars.withColumn(CHUNK, grid.chunk())
        .groupBy("ticker", CHUNK)
        .agg(
            F.array_sort(F.collect_list(bar)).alias("ohlcv"),
            F.count("*").alias("rows"),
            F.min("Date").alias("start_date"),
            F.max("Date").alias("end_date"),
        )
    )
    if tickers is None:
        df = df.withColumns({"company_name": F.col("ticker"), "sector": F.lit("Unknown")})
    else:
        df = describe_tickers(df, tickers)
    if fundamentals is None:
        facts = F.lit(None).cast("array<struct<ticker:string>>")
    else:
        row = F.array(F.struct(*fundamentals.columns)).alias("fundamentals")
        df = join_dimension(df, fundamentals.select("ticker", row), "ticker")
        facts = F.col("fundamentals")
    metadata = F.struct(
        (fetched_at if fetched_at is not None else F.current_timestamp()).alias("fetched_at"),
        "rows",
        F.col("start_date").cast("string").alias("start_date"),
        F.col("end_date").cast("string").alias("end_date"),
    )
    head = ["ticker", "company_name", "sector", "ohlcv"]
    with_facts = F.to_json(F.struct(*head, facts.alias("fundamentals"), metadata.alias("metadata")))
    # A ticker without fundamentals carries an empty object instead of a list.
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    without = F.to_json(F.struct(*head, empty.alias("fundamentals"), metadata.alias("metadata")))
    value = F.when(facts.isNull(), without).otherwise(with_facts)
    return df.select("ticker", F.col(CHUNK).alias("part"), value.alias("value"))


def add_envelope(messages: DataFrame, published_at: Column | None = None) -> DataFrame:
    """Append `publish_metadata` to each JSON object in `value`."""
    at = published_at if published_at is not None else F.current_timestamp()
    meta = F.to_json(
        F.struct(
            at.alias("published_at"),
            F.lit(SOURCE).alias("source"),
            F.lit(SCHEMA_VERSION).alias("schema_version"),
        )
    )
    body = F.rtrim("value")
    opened = F.substring(body, F.lit(1), F.length(body) - 1)
    comma = F.when(F.regexp_like(body, F.lit(r"^\s*\{\s*\}$")), F.lit("")).otherwise(F.lit(","))
    return messages.withColumn(
        "value", F.concat(opened, comma, F.lit('"publish_metadata":'), meta, F.lit("}"))
    )


def _is(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def _get(value: Column, key: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, f"$.{key}", kind)


def parse_messages(raw: DataFrame) -> DataFrame:
    """Add `doc` (variant, null for broken JSON) to rows with a JSON `value`."""
    # NaN and infinities are not JSON but common; quoted, they read as numbers.
    quoted = F.regexp_replace("value", r"(:\s*)(NaN|-?Infinity)(?=\s*[,}\]])", r'$1"$2"')
    doc = F.coalesce(F.try_parse_json("value"), F.try_parse_json(quoted))
    return raw.withColumn("doc", doc)


def _read_bars(bars: Column) -> Column:
    """Each element of `bars` with its four checked fields as (given, text, float, int).

    The float or int of a field is null if it stands for no such number, and 0 if
    the field is absent. Done in small steps: every variant is looked up once.
    """
    fields = F.transform(
        bars,
        lambda bar: F.struct(
            _is(bar, "OBJECT").alias("is_object"),
            _get(bar, "Date", "string").alias("Date"),
            *[_get(bar, name).alias(name) for name in NUMBERS],
        ),
    )
    sorted_out = F.transform(
        fields,
        lambda f: F.struct(
            f["is_object"],
            f["Date"],
            *[
                F.struct(
                    F.schema_of_variant(f[name]).alias("kind"),
                    F.try_variant_get(f[name], "$", "double").alias("number"),
                    f[name].alias("raw"),
                ).alias(name)
                for name in NUMBERS
            ],
        ),
    )
    return F.transform(
        sorted_out,
        lambda f: F.struct(
            f["is_object"],
            f["Date"],
            *[
                F.struct(
                    f[name]["kind"].isNotNull().alias("given"),
                    _text(f[name]).alias("text"),
                    (_as_int if name == "Volume" else _as_float)(f[name]).alias("value"),
                ).alias(name)
                for name in NUMBERS
            ],
        ),
    )


def _text(field: Column) -> Column:
    """What the field says, unless it is a plain number."""
    plain = field["number"].isNotNull() & (field["kind"] != "STRING")
    return F.when(~plain, F.try_variant_get(field["raw"], "$", "string"))


def _as_float(field: Column) -> Column:
    text = _text(field)
    plain = F.regexp_like(text, F.lit(FLOAT_TEXT)) | F.regexp_like(text, F.lit(FLOAT_WORD))
    return (
        F.when(field["kind"].isNull(), F.lit(0.0))
        .when(field["kind"] != "STRING", field["number"])
        .when(plain, F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("double"))
    )


def _as_int(field: Column) -> Column:
    """Fractions of numbers are cut off, fractions in texts are no whole numbers."""
    text = _text(field)
    whole = F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("decimal(38,0)")
    cut = F.when(field["number"] < 0, F.ceil(field["number"])).otherwise(F.floor(field["number"]))
    exact = F.coalesce(
        F.try_variant_get(field["raw"], "$", "bigint").cast("decimal(38,0)"),
        cut.try_cast("decimal(38,0)"),
    )
    return (
        F.when(field["kind"].isNull(), F.lit(0).cast("decimal(38,0)"))
        .when(field["kind"] != "STRING", exact)
        .when(F.regexp_like(text, F.lit(INT_TEXT)), whole)
    )


def _error(code: str, index: Column | None = None, field: str | None = None, value: Column | None = None) -> Column:
    return F.struct(
        F.lit(code).alias("code"),
        (index if index is not None else F.lit(None)).cast("int").alias("row_index"),
        F.lit(field).cast("string").alias("field"),
        (value if value is not None else F.lit(None)).cast("string").alias("value"),
    )


def _bar_errors(bar: Column, index: Column) -> Column:
    """Errors of one read bar. After a field that is no number, later checks are skipped."""
    nothing = F.array().cast(ERRORS)

    def only(condition: Column, error: Column) -> Column:
        return F.when(condition, F.array(error)).otherwise(nothing)

    def bad(field: str) -> Column:
        return F.array(_error("type_error", index, field, bar[field]["text"]))

    close, volume = bar["Close"]["value"], bar["Volume"]["value"]
    high, low = bar["High"]["value"], bar["Low"]["value"]
    crossed = ~F.isnan(high) & ~F.isnan(low) & (high < low)
    unread = bar["Date"].isNotNull() & bar["Date"].try_cast("timestamp_ntz").isNull()
    date = only(unread, _error("type_error", index, "Date", bar["Date"]))
    price = only(close <= 0, _error("invalid_close", index, "Close", close))
    amount = only(volume < 0, _error("negative_volume", index, "Volume", volume))
    span = only(crossed, _error("high_below_low", index, "High", high))
    return (
        F.when(~bar["is_object"], F.array(_error("type_error", index)))
        .when(close.isNull(), bad("Close"))
        .when(volume.isNull(), F.concat(price, bad("Volume")))
        .when(high.isNull(), F.concat(price, amount, bad("High")))
        .when(low.isNull(), F.concat(price, amount, bad("Low")))
        .otherwise(F.concat(price, amount, span, date))
        .cast(ERRORS)
    )


def validate_messages(parsed: DataFrame) -> DataFrame:
    """Add `bars`, `errors` and `is_valid` to parsed messages. One bad bar fails all."""
    doc, bars = F.col("doc"), F.col("_elements")
    ohlcv = _get(doc, "ohlcv")
    # Nothing there: absent, null, "", 0, false, [] or {}.
    empty = (
        ohlcv.isNull()
        | F.is_variant_null(ohlcv)
        | (F.size(bars) == 0)
        | (F.size(F.map_keys(F.try_variant_get(ohlcv, "$", "map<string,variant>"))) == 0)
        | F.when(_is(ohlcv, "STRING"), F.try_variant_get(ohlcv, "$", "string") == "").otherwise(
            F.try_variant_get(ohlcv, "$", "double") == 0
        )
    )
    first = F.try_element_at(bars, F.lit(1))
    present = F.map_keys(F.try_variant_get(first, "$", "map<string,variant>"))
    missing = F.when(
        _is(first, "OBJECT"),
        F.array_except(F.array(*[F.lit(f) for f in REQUIRED]), present),
    ).otherwise(F.array().cast("array<string>"))
    no_field = F.transform(missing, lambda name: F.struct(
        F.lit("missing_field").alias("code"),
        F.lit(0).alias("row_index"),
        name.alias("field"),
        F.lit(None).cast("string").alias("value"),
    ))
    per_bar = F.flatten(F.transform("bars", _bar_errors))

    def one(code: str) -> Column:
        return F.array(_error(code)).cast(ERRORS)

    # The usual case comes before the tests that only tell broken ones apart.
    errors = (
        F.when(doc.isNull(), one("broken_json"))
        .when(
            _get(doc, "ticker").isNull(),
            F.when(_is(doc, "OBJECT"), one("missing_ticker")).otherwise(one("not_an_object")),
        )
        .when(F.size(bars) > 0, F.concat(no_field.cast(ERRORS), per_bar))
        .when(F.coalesce(empty, F.lit(False)), one("missing_ohlcv"))
        .otherwise(one("ohlcv_not_a_list"))
    )
    return (
        parsed.withColumn("_elements", F.try_variant_get("doc", "$.ohlcv", "array<variant>"))
        .withColumn("bars", _read_bars(bars))
        .withColumn("errors", errors)
        .withColumn("is_valid", F.size("errors") == 0)
        .drop("_elements")
    )


def valid_messages(validated: DataFrame) -> DataFrame:
    return validated.filter("is_valid")


def rejected_messages(validated: DataFrame) -> DataFrame:
    """Messages that failed, whole, with what is wrong with them."""
    return validated.filter(~F.col("is_valid")).drop("doc", "bars", "is_valid")


def flatten_messages(
    validated: DataFrame,
    *keep: str,
    more_bar_fields: Sequence[str] = (),
    more_fundamentals: Sequence[str] = (),
    others: bool = False,
) -> DataFrame:
    """One row per bar of the valid messages.

    Of bars with the same date in a message the first is kept. The message's
    fundamentals, name and sector are repeated on every bar. `keep` names
    further columns of the input to carry along, `more_…` further numbers of a
    bar or of the fundamentals; names such as "Adj Close" may hold spaces. With
    `others`, all further keys, named by nobody, are kept as JSON texts in the maps
    `other_bar` and `other_fundamentals`; `other_bar` also has a volume that is not
    whole, or too large, as it was given. `spread` makes columns of such a map.
    """
    elements = F.try_variant_get("doc", "$.ohlcv", "array<variant>")

    def number(value: Column, name: str) -> Column:
        return F.try_variant_get(value, f'$["{name}"]', "double").alias(name)

    def typed(bar: Column, index: Column) -> Column:
        def given(field: str, kind: str) -> Column:
            value = F.when(bar[field]["given"], bar[field]["value"]).try_cast(kind)
            return F.nanvl(value, F.lit(None)) if kind == "double" else value

        return F.struct(
            bar["Date"].try_cast("timestamp_ntz").alias("Date"),
            index.alias("at"),
            *[given(c, "double").alias(c) for c in NUMBERS if c != "Volume"],
            given("Volume", "bigint").alias("Volume"),
            *[number(F.try_element_at(elements, index + 1), c) for c in more_bar_fields],
            *([_others(F.try_element_at(elements, index + 1), known_bar).alias("other_bar")] if others else []),
        )

    known_bar = [*BAR_FIELDS, *more_bar_fields]
    known_facts = [*FUNDAMENTAL_VALUES, *more_fundamentals, "ticker", "company_name", "sector"]

    facts = F.coalesce(
        F.try_element_at(F.try_variant_get("doc", "$.fundamentals", "array<variant>"), F.lit(1)),
        _get(F.col("doc"), "fundamentals"),
    )
    df = valid_messages(validated).select(
        *keep,
        _get(F.col("doc"), "ticker", "string").alias("ticker"),
        F.coalesce(_get(F.col("doc"), "company_name", "string"), _get(F.col("doc"), "ticker", "string")).alias("company_name"),
        F.coalesce(_get(F.col("doc"), "sector", "string"), F.lit("Unknown")).alias("sector"),
        facts.alias("facts"),
        F.array_sort(F.transform("bars", typed)).alias("bars"),
        *([_others(facts, known_facts).alias("other_fundamentals")] if others else []),
    )
    further = ["other_fundamentals"] if others else []
    # Sorted by date and place: a bar equal in date to the one before is a repeat.
    shifted = F.concat(F.array(F.lit(None).cast("timestamp_ntz")), F.col("bars.Date"))
    marked = F.arrays_zip(F.col("bars").alias("bar"), shifted.alias("before"))
    fresh = F.filter(
        marked,
        lambda m: m["bar"].isNotNull() & ~(m["bar"]["Date"].eqNullSafe(m["before"]) & (m["before"].isNotNull())),
    )
    df = df.withColumn("fresh", fresh).select(
        *keep, "ticker", "company_name", "sector", "facts", *further, F.explode("fresh.bar").alias("bar")
    )
    if others:
        further = [F.map_from_entries(F.col("bar")["other_bar"]).alias("other_bar")]
        further += [F.map_from_entries("other_fundamentals").alias("other_fundamentals")]
    return df.select(
        *keep,
        "ticker",
        *[F.col("bar")[c].alias(c) for c in [*BAR_FIELDS, *more_bar_fields]],
        *[number(F.col("facts"), name) for name in [*FUNDAMENTAL_VALUES, *more_fundamentals]],
        "company_name",
        "sector",
        *further,
    )


def _others(value: Column, known: Sequence[str]) -> Column:
    """Keys of an object that are not `known`, by name, each with its JSON text."""
    fields = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    fields = F.transform(
        fields, lambda f: F.struct(f["key"].alias("key"), F.to_json(f["value"]).alias("value"))
    )

    def unknown(field: Column) -> Column:
        odd_volume = (field["key"] == "Volume") & field["value"].try_cast("bigint").isNull()
        number = field["value"].rlike(r"^-?[0-9]")
        return ~field["key"].isin(*known) | (odd_volume & number & F.lit("Volume" in known))

    return F.array_sort(F.coalesce(F.filter(fields, unknown), F.array().cast(_ENTRIES)))


_ENTRIES = "array<struct<key:string,value:string>>"
SPREAD_KEYS = 1_000


def spread(df: DataFrame, column: str) -> DataFrame:
    """`df` with a column for every key in the map `column` of JSON texts, whatever keys there are.

    Types are those that hold all values of a key: numbers, booleans and texts; objects,
    lists and mixed values stay JSON texts. A key that is a column already replaces it. The
    list of keys goes to the driver: at most `SPREAD_KEYS`, else an error.
    """
    value = F.try_parse_json("value")
    kinds = (
        df.select(F.explode(column))
        .groupBy("key")
        .agg(F.schema_of_variant_agg(value).alias("kind"))
        .orderBy("key")
        .take(SPREAD_KEYS + 1)
    )
    if len(kinds) > SPREAD_KEYS:
        raise ValueError(f"more than {SPREAD_KEYS} keys in {column}")

    def typed(key: str, kind: str) -> Column:
        text = F.try_element_at(column, F.lit(key))
        kind = "double" if kind.startswith("DECIMAL") else kind.lower()
        if kind not in ("double", "float", "bigint", "boolean", "string"):
            return text
        return F.try_variant_get(F.try_parse_json(text), "$", kind)

    return df.withColumns({k["key"]: typed(*k) for k in kinds}).drop(column)


def message_stats(validated: DataFrame) -> DataFrame:
    """One row: messages received, valid, invalid, and the valid share as text."""
    valid = F.count_if("is_valid")
    return validated.agg(
        F.count("*").alias("received"),
        valid.alias("valid"),
        (F.count("*") - valid).alias("invalid"),
        percent_text(valid, F.count("*")).alias("validation_rate"),
    )


def publish_stats(published: DataFrame) -> DataFrame:
    """One row: messages sent, errors, and the sent share, from a `sent` column."""
    sent = F.count_if("sent")
    return published.agg(
        sent.alias("messages_sent"),
        (F.count("*") - sent).alias("errors"),
        percent_text(sent, F.count("*")).alias("success_rate"),
    )
