"""Every named query against its SQL counterpart."""

import collections
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from razonete.plans.catalogue import QUERIES
from razonete.plans.oracle import ORACLE



@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for file in os.listdir(folder):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE.items() <= entry_points.oracle_sql().items()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    found = collections.Counter(tuple(plain(row[c]) for c in columns) for row in df.collect())
    relation = duck.execute(ORACLE[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = collections.Counter(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    assert found == expected
    assert found or name == "incremental_by_name"  # the smallest tables hold a text for every customer


def test_entry_lists_documents(spark):
    assert entry_points.entry(spark).columns[0] == "document_name"
