"""Driver contract: entry(), every registered query against its DuckDB SQL."""

import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql
from fanwrite.plans.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    return sorted(tuple("<NULL>" if v is None or (isinstance(v, float) and pd.isna(v)) else str(v) for v in r) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["table_name", "events"]
    assert sum(r["events"] for r in rows) == 1000


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    got = QUERIES[name](spark, sf_small).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    assert norm(got) == norm(want)
