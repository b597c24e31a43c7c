"""Each registered query against its SQL, and the contract of the entry module."""

import os
from datetime import date
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from quern.plans import catalog, chains, records, scans  # noqa: F401


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return c


def plain(value):
    if isinstance(value, float | Decimal):
        return round(float(value), 6)
    if isinstance(value, list | tuple):
        return tuple(map(plain, value))
    return str(value) if isinstance(value, date) else value


def rows(found, order):
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, duck, name):
    own = catalog.QUERIES[name](spark, data)
    got = own.collect()
    if name in catalog.ORACLE:
        other = duck.sql(catalog.ORACLE[name])
        columns = sorted(other.columns)
        assert sorted(own.columns) == columns
        assert rows(got, [own.columns.index(c) for c in columns]) == rows(other.fetchall(), [other.columns.index(c) for c in columns])


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
