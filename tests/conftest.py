import numbers
import os
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", f"file://{shared}").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def same(df, con, sql):
    """Do both give the same rows, whatever their order?"""
    got, want = df.toPandas(), con.execute(sql).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)

    def rows(frame):
        plain = lambda v: None if pd.isna(v) else round(float(v), 9) if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)
        return sorted((tuple(map(plain, r)) for r in frame[cols].itertuples(index=False)), key=repr)

    assert rows(got) == rows(want)
