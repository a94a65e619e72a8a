import os
import sys
import tempfile
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows_of(frame):
    """Rows of a pandas frame in one order, columns by name, numbers as floats to nine places."""

    def plain(v):
        if v is None or v is pd.NA or v != v:
            return None
        if isinstance(v, (bool, str)):
            return v
        try:
            return round(float(v), 9)
        except (TypeError, ValueError):
            return str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False)), key=lambda r: tuple(map(str, r)))


@pytest.fixture(scope="session")
def same(duck):
    """Assert that a DataFrame and a DuckDB query give the same rows and columns."""

    def check(df, sql):
        got, want = df.toPandas(), duck.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)

    return check
