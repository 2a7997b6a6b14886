from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(folder / "warehouse"))
               .config("spark.checkpoint.dir", f"file://{folder}/shared").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    folder = f"{DATA}/sf0.001"
    for name in os.listdir(folder):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
    return con


def plain(value):
    """A value as both engines would show it."""
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if hasattr(value, "isoformat"):
        return str(value).replace("T", " ")
    if isinstance(value, (int, float)) or hasattr(value, "__float__"):
        return round(float(value), 6)
    return value


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def oracle_rows(con, sql):
    found = con.sql(sql)
    at = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    return [found.columns[i] for i in at], sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
