"""Every driver query against its SQL in DuckDB, at the smallest scale."""

import duckdb
import pytest

from trialcohort.plans import driver_queries, oracle

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(driver_queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(driver_queries.queries()))
def test_query(spark, duck, name):
    df = driver_queries.queries()[name](spark, FOLDER)
    got = by_name(df.columns, df.collect())
    result = duck.execute(oracle.oracle_sql()[name])
    expected = by_name([d[0] for d in result.description], result.fetchall())
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert got[1]
