"""Every registered query of the library's own operators against DuckDB."""

import datetime

import duckdb
import pandas as pd
import pytest

from gridspark.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


def rows(df):
    df = df[sorted(df.columns)].copy()
    for c in df:
        known = df[c].dropna()
        if len(known) and isinstance(known.iloc[0], datetime.date) and not isinstance(known.iloc[0], pd.Timestamp):
            df[c] = pd.to_datetime(df[c])
        if str(df[c].dtype).lower().startswith(("int", "float")):
            df[c] = df[c].astype("float64")
    return sorted(map(repr, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, DATA).toPandas()
    sql = catalog.oracle_sql().get(name)
    if sql:
        assert rows(got) == rows(duck.execute(sql).df())
    else:
        assert len(got)


def test_zone_weights_add_up(spark):
    zones = catalog.queries()["zone_clusters"](spark, DATA).toPandas()
    assert (zones.groupby("c_nationkey").weight.sum() - 1).abs().max() < 1e-9
