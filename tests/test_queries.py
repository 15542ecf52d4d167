"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tidemark import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the supplied tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return float(f"{v:.9g}") if isinstance(v, float) else v


def table(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(x) for x in r) for r in df[names].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, duck, name):
    assert table(catalogue.QUERIES[name](spark, SF).toPandas()) == table(duck.sql(catalogue.ORACLES[name]).df())


def test_queries_without_sql_have_rows(spark):
    for name in sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)):
        assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_grids_hold_every_event(spark, tmp_path):
    times = ["2024-01-01 00:00:00", "2024-01-25 06:30:00", "2024-02-20 12:00:00"]
    rows = spark.createDataFrame([(k, t, k, "click", 1.0, None) for k, t in enumerate(times)], "event_id long, ts string, user_id long, event_type string, value double, props string")
    rows.withColumn("ts", rows.ts.cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    assert sum(r.n for r in catalogue.QUERIES["k2_indicator_whole"](spark, str(tmp_path)).collect()) == 3
    assert sum(r["mean"] is not None for r in catalogue.QUERIES["w8_marks_per_bin"](spark, str(tmp_path)).collect()) == 3
