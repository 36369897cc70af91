"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry

SF = TESTDATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return (0, "")
    return (1, value.isoformat() if hasattr(value, "isoformat") else str(value))


def _sorted(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(record[i]) for i in order) for record in records)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, sql, name):
    df = entry.queries()[name](spark, str(SF))
    got = _sorted(df.columns, df.collect())
    if name not in entry.oracle_sql():
        assert got
        return
    result = sql.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == _sorted(names, result.fetchall())


def test_flagship_has_three_rows(spark):
    assert entry.entry(spark).count() == 3


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
