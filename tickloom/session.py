"""Session settings shared by batch and streaming jobs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Set only where the cluster, the submit command or the caller says nothing.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's defaults; `settings` uses `_` for `.` in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for name, value in DEFAULTS.items():
        if not given.contains(name):
            spark.conf.set(name, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session that names none gets a fresh temporary folder; a
    cluster without the setting is an error, as a machine-local folder would
    be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = os.path.join(tempfile.mkdtemp(prefix="run-"), "checkpoints")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def use_checkpoints(spark: SparkSession) -> str:
    """Point `DataFrame.checkpoint()` and ML checkpoints at `checkpoint_dir`."""
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
