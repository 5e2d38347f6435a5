"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from docgate.plans.catalog import QUERIES
from docgate.plans.oracle import ORACLE

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in os.listdir(DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{file}'")
    return connection


def test_both_sides_register_the_same_keys():
    # Of the optional part, queries that SQL cannot express have tests of their own.
    assert QUERIES.keys() == ORACLE.keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("key", entry_points.oracle_sql())
def test_query_matches_sql(spark, sql, key):
    df = entry_points.queries()[key](spark, DIR)
    cursor = sql.execute(entry_points.oracle_sql()[key])
    names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(map(repr, cursor.fetchall()))
    got = sorted(repr(tuple(row)) for row in df.select(*names).collect())
    assert got and got == want
