"""Every registered query against its SQL counterpart on the same tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def normal(value):
    if isinstance(value, float):
        return round(value, 9)
    return value


def ordered(rows, names):
    positions = [names.index(name) for name in sorted(names)]
    picked = [tuple(normal(row[i]) for i in positions) for row in rows]
    return sorted(picked, key=repr)


def test_every_query_has_a_counterpart():
    assert set(entry.core_oracle_sql()) == set(entry.core_queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = oracle.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = ordered(result.fetchall(), names)
    actual = ordered([tuple(row) for row in df.collect()], df.columns)
    assert len(actual) == len(expected)
    assert actual == expected


def test_entry(spark):
    assert entry.entry(spark).agg({"doc_count": "sum"}).first()[0] > 0
