import os
import sys
import tempfile

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", scratch).config("spark.sql.warehouse.dir", f"{scratch}/warehouse").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows_of(frame):
    """Rows as text, sorted, with columns by name."""
    frame = frame[sorted(frame.columns)]

    def text(v):
        if v is None or v is pd.NA or isinstance(v, float) and v != v:
            return "None"
        if isinstance(v, float) and v == int(v):
            return str(int(v))
        return str(v)

    return sorted(tuple(map(text, r)) for r in frame.astype(object).itertuples(index=False))


@pytest.fixture
def same(spark, duck, sf):
    def check(query, sql):
        got, want = query(spark, sf).toPandas(), duck.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)

    return check
