"""Every query with SQL against an in-process DuckDB, on the smallest tables."""

import duckdb
import pytest

from assayer.plans import catalog
from check_oracle import TABLES, compare


@pytest.fixture(scope="session")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_its_sql(spark, sf, db, name):
    df = catalog.QUERIES[name](spark, sf)
    cur = db.execute(catalog.ORACLE[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description]) == ""


def test_every_sql_has_a_query():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
