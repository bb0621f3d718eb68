"""Draining message files as a stream: parse, validate, flatten, write, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.messages import (
    flatten_messages,
    parse_messages,
    rejected_messages,
    validate_messages,
)


def read_message_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """`file, value`: every file of a folder as one message."""
    return (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", pattern)
        .text(folder)
        .select(F.col("_metadata.file_name").alias("file"), "value")
    )


def message_stream(
    spark: SparkSession, folder: str, files_per_batch: int = 1_000, whole_files: bool = True
) -> DataFrame:
    """`file, value` of files as they arrive, `files_per_batch` at a time.

    A file is one message, or with `whole_files` off one message per line.
    """
    return (
        spark.readStream.format("text")
        .option("wholetext", whole_files)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(F.col("_metadata.file_name").alias("file"), "value")
    )


def write_batch(out: str):
    """Writer of one micro-batch: valid bars, rejected messages, counts.

    Each batch overwrites its own folder, so a batch that is run again after a
    failure replaces what it wrote before.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        target = f"batch={number}"
        flatten_messages(batch, "file").write.mode("overwrite").parquet(f"{out}/valid/{target}")
        rejected_messages(batch).write.mode("overwrite").parquet(f"{out}/rejected/{target}")
        (
            batch.groupBy("is_valid")
            .agg(F.count("*").alias("messages"))
            .write.mode("overwrite")
            .parquet(f"{out}/counts/{target}")
        )
        batch.unpersist()

    return write


def drain_messages(
    spark: SparkSession,
    folder: str,
    out: str,
    progress: str,
    files_per_batch: int = 1_000,
    whole_files: bool = True,
) -> None:
    """Process all files that wait in `folder`, then stop.

    Broken JSON and invalid messages go to `rejected`; they never stop the
    stream. `progress` remembers which files are done.
    """
    stream = message_stream(spark, folder, files_per_batch, whole_files)
    running = (
        validate_messages(parse_messages(stream))
        .writeStream.foreachBatch(write_batch(out))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()


def stored_stats(spark: SparkSession, out: str) -> DataFrame:
    """One row: messages received, valid, invalid and the valid share of all batches."""
    counts = spark.read.parquet(f"{out}/counts")
    valid = F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("messages"))), F.lit(0))
    total = F.coalesce(F.sum("messages"), F.lit(0))
    return counts.agg(
        total.alias("received"),
        valid.alias("valid"),
        (total - valid).alias("invalid"),
        F.format_string("%.1f%%", valid * 100.0 / F.greatest(total, F.lit(1))).alias("validation_rate"),
    )
