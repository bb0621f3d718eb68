"""Writing tables and files. Everything is written by the executors."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.columns import safe_name
from tickloom.operators.chunks import BarGrid
from tickloom.operators.snapshot import latest

# Date format of the exported files: ISO, to the microsecond.
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DATES = {"timestampNTZFormat": ISO, "timestampFormat": ISO}


def write_table(df: DataFrame, name: str) -> None:
    """Replace a stored table; running it again gives the same table.

    Each write makes a table of its own, `name__v…`, and `name` is a view that is switched to it
    in one step of the catalog. Until then, and if the write fails, `name` gives the old
    rows, so `df` may read it. The version before stays for queries that still read it.
    """
    spark = df.sparkSession
    stored = f"{name}__v{time.time_ns():020d}"
    try:
        df.write.saveAsTable(stored)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {stored}")
        raise
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v{0:020d}")  # written without versions
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {stored}")
    for old in _versions(spark, name)[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Tables that hold versions of `name`, the oldest first."""
    *database, table = name.split(".")
    found = spark.catalog.listTables(*database, pattern=f"{table}__v*")
    return sorted(".".join([*database, t.name]) for t in found)


def write_parquet(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; dates in ISO form."""
    df.write.mode("overwrite").options(**DATES).csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line; nulls are kept and dates are in ISO form."""
    df.write.mode("overwrite").options(**DATES).json(path, ignoreNullFields=False)


def write_history(df: DataFrame, path: str, grid: BarGrid) -> None:
    """JSON records per ticker, in order of date.

    Folders are `safe_ticker=…/since=…` and sort like time. A ticker shorter than
    a chunk is one file, a longer one is written by as many tasks as it has chunks.
    """
    keys = ["safe_ticker", "since"]
    split = df.withColumns({"safe_ticker": safe_name(F.col("ticker")), "since": grid.chunk_since()})
    (
        split.repartition(*keys)
        .sortWithinPartitions(*keys, "Date")
        .write.mode("overwrite")
        .partitionBy(*keys)
        .options(**DATES)
        .json(path, ignoreNullFields=False)
    )


def export(df: DataFrame, folder: str, grid: BarGrid) -> None:
    """Full table and latest rows as CSV, latest rows as JSON, history per ticker."""
    write_csv(df, f"{folder}/full_csv")
    newest = latest(df)
    write_csv(newest, f"{folder}/latest_csv")
    write_json(newest.orderBy("ticker"), f"{folder}/latest_json")
    write_history(df, f"{folder}/history", grid)


def write_message_files(messages: DataFrame, path: str) -> None:
    """One text file per message, in a folder per ticker and part."""
    (
        messages.select(safe_name(F.col("ticker")).alias("safe_ticker"), "part", "value")
        .repartition("safe_ticker", "part")
        .write.mode("overwrite")
        .partitionBy("safe_ticker", "part")
        .text(path)
    )


def write_validated(df: DataFrame, folder: str) -> bool:
    """Parquet, CSV and JSON copies of a table; False and no files if it is empty."""
    if df.isEmpty():
        return False
    write_parquet(df, f"{folder}/stock_data_parquet")
    stored = df.sparkSession.read.parquet(f"{folder}/stock_data_parquet")
    write_csv(stored, f"{folder}/stock_data_csv")
    write_json(stored, f"{folder}/stock_data_json")
    return True


def replace_serving(spark: SparkSession, rows: DataFrame, table: str) -> int:
    """Replace all rows of the serving table at once and return their number."""
    write_table(rows, table)
    return spark.table(table).count()


def publish(messages: DataFrame, path: str, batch: str) -> DataFrame:
    """Put messages into a queue folder as `key, value` rows of one named batch.

    A batch that is published again after a failure replaces itself. Returns the
    messages with `sent`: a message goes out if it is valid JSON.
    """
    status = messages.withColumn("sent", F.try_parse_json("value").isNotNull())
    rows = status.filter("sent").select(F.col("ticker").alias("key"), "value")
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return status
