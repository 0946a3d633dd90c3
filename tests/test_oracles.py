"""Every registered query against its SQL twin in DuckDB, at the smallest scale."""

import duckdb
import pytest
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from tillflow.catalog import QUERIES as CATALOGUE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = dict(CATALOGUE), {name: oracle_sql()[name] for name in CATALOGUE}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


def test_entry(spark):
    assert entry(spark).limit(5).count() == 5


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    ours = sorted(repr(tuple(r[c] for c in names)) for r in df.collect())
    cursor = duck.execute(ORACLES[name])
    theirs_names = [d[0] for d in cursor.description]
    assert sorted(theirs_names) == names
    at = [theirs_names.index(c) for c in names]
    theirs = sorted(repr(tuple(r[i] for i in at)) for r in cursor.fetchall())
    assert ours == theirs
    assert ours, "a check without rows proves nothing"
