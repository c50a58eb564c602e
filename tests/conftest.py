import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "3g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return con


def plain(value):
    """A value as either engine gives it, made comparable."""
    if hasattr(value, "item"):
        value = value.item()
    if value is None or value != value:
        return None
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return round(float(value), 7)
    return str(value)[:26]


def same(df, con, sql):
    """Both engines' rows as sorted lists, under the same column names."""
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    a = sorted((tuple(map(plain, r)) for r in df.select(*names).collect()), key=str)
    b = sorted((tuple(map(plain, r)) for r in want.fetchall()), key=str)
    assert a == b
