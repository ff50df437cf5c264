"""Every query with a SQL counterpart against DuckDB on the driver's smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    types = dict(zip(names, (str(column[1]) for column in result.description)))
    assert sorted(names) == sorted(df.columns)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    want = sorted(tuple(repr(row[names.index(c)]) for c in df.columns) for row in result.fetchall())
    got = sorted(tuple(map(repr, row)) for row in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
