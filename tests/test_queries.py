"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.queries import ORACLES as TWINS, QUERIES
from tests.conftest import SF_DIR
from verify import TABLES, normal


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(TWINS) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(TWINS) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cur = duck.execute(TWINS[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    got = normal(df.collect(), df.columns)
    assert got and got == normal(cur.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
