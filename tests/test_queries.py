"""Every registered query against its SQL at the smallest scale, and the entry point."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import TABLES, normal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    assert got
    if name in oracle_sql():
        other = db.execute(oracle_sql()[name])
        names = [d[0] for d in other.description]
        assert sorted(names) == sorted(df.columns)
        assert got == normal(other.fetchall(), names)


def test_entry(spark):
    assert entry(spark).count() > 0
