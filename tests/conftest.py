"""A local session and the test tables in DuckDB."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [HOME, os.path.join(HOME, "tests")]

from compared import DATA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import geoloom

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    geoloom.reach(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    return con
