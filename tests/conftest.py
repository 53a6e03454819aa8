import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def panel_of(spark):
    """Panel rows from parallel lists: one ticker unless given, consecutive days."""
    from datetime import date, timedelta

    def build(xs, ys, zs=None, ticker="T", start=date(2024, 1, 1)):
        zs = zs if zs is not None else [None] * len(xs)
        rows = [
            (start + timedelta(days=i), ticker, float(y), x, z)
            for i, (x, y, z) in enumerate(zip(xs, ys, zs))
        ]
        return spark.createDataFrame(
            rows, "date date, ticker string, ret double, avg_a_lag1 double, avg_b_lag1 double"
        )

    return build
