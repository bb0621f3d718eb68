"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written to the noop sink, so all of its rows are computed. A figure
is the median of $BENCH_RUNS runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import REGISTRY  # noqa: E402
from tickloom.session import build_session  # noqa: E402

HEADLINE = [
    "bars_hourly",
    "bars_daily",
    "evaluated_bars",
    "evaluated_bars_full",
    "latest_snapshot",
    "decision_distribution",
    "quality_report",
    "position_trades",
    "backtest_metrics",
    "strategy_grid",
    "message_flatten",
    "message_validation",
    "feature_matrix",
    "auc_rank_sum",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    figures = {}
    for name in HEADLINE:
        seconds(name)
        figures[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(figures.values()), 3),
        "unit": "sec",
        "queries": figures,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
