"""Small helpers shared by the operators."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import use_checkpoints

SPACES = " \t\n\x0b\f\r"


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold 2,000 rows, as rows are whole texts, unless the cluster says more."""
    if not spark.sparkContext.getConf().contains(BATCH):
        spark.conf.set(BATCH, 2_000)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """`df` computed once and stored in the shared checkpoint folder."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def without_spaces(text: Column) -> Column:
    """Text without the six ASCII space characters; null is empty."""
    text = F.coalesce(text, F.lit(""))
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


BROADCAST_IDS = 500_000


def only(rows: DataFrame, wanted: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ids are in `wanted` (all its columns), or are not; few are broadcast.

    `wanted` holds some 8 to 40 bytes a row; beyond `BROADCAST_IDS` it is shuffled.
    """
    few = wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    found = rows.join(F.broadcast(wanted) if few else wanted, wanted.columns, how)
    return found.select(*[F.col(f"`{c}`") for c in rows.columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_state() -> types.ModuleType:
    """A place in the worker process that outlives the task, for loaded files and caches."""
    name = "_tickloom_llm_state"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name]
