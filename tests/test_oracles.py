"""Every registered query against its SQL, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from checks.registry import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    expected = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    order = [expected.columns.index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in order)) for row in expected.fetchall())
    got = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    assert got == want


def test_every_query_of_the_catalog_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and "min_ram_gb" in df.columns
