"""The driver contract: entry() smoke, and every registered query equal to its DuckDB oracle."""

import duckdb
import pandas as pd
import pytest
from conftest import SF001

import __spark_entry__ as entry
from rivulet.plans.catalog import QUERIES
from rivulet.plans.oracle import ORACLE_SQL

TABLES = ["events"]


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
        df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "count"]
    assert df.count() > 0


def test_every_query_over_events_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(ORACLE_SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF001).toPandas()
    exp = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _canon(got).equals(_canon(exp))
