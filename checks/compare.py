"""Run registered queries on Spark and as SQL on DuckDB and compare the rows.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import REGISTRY
from tickloom.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None if both sides agree, otherwise what differs."""
    df = REGISTRY[name](spark, sf_dir)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None if ours else "no rows"
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    theirs = normal(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if ours != theirs:
        only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
        sample = (sorted(only_ours)[:2], sorted(only_theirs)[:2])
        return f"{len(ours)} / {len(theirs)} rows, {len(only_ours)} differ: {sample}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        "compare",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="12g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            wrong = differences(spark, con, name, sf_dir)
        except Exception as error:  # keep going: one report for all queries
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        failed += wrong is not None
        kind = "rows" if name not in ORACLES else "sql"
        print(f"{'FAIL' if wrong else 'ok':4} {time.time() - start:6.1f}s {kind:4} {name} {wrong or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
