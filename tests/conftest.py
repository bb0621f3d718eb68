from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tickloom.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="2",
        spark_ui_showConsoleProgress="false",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="session")
def series(spark):
    """Bars of tickers given as lists of closes, one per day; None stays null."""

    def build(**closes):
        rows = [
            (ticker, day(i), close, 100 + i)
            for ticker, values in closes.items()
            for i, close in enumerate(values)
        ]
        return spark.createDataFrame(
            rows, "ticker string, Date timestamp_ntz, Close double, Volume bigint"
        )

    return build


def by_date(df, ticker="T"):
    rows = df.filter(df.ticker == ticker).collect()
    return sorted(rows, key=lambda r: r["Date"])
