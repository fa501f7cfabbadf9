"""Every registered query with SQL agrees with DuckDB on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_of

SKIP_HEAVY = {"resample_first_10s"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SKIP_HEAVY))
def test_query_matches_sql(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    ddf = con.execute(E.oracle_sql()[name]).df()
    c1, r1 = rows_of(sdf)
    c2, r2 = rows_of(ddf)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) >= 3
    assert df.count() >= 0


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())
