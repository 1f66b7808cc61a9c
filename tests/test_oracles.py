"""Every query against its SQL statement in DuckDB, on the same Parquet tables."""

import math
import os

import duckdb
import pytest

from eventloom.catalog.oracles import ORACLES
from eventloom.catalog.queries import REGISTRY

SF_DIR = os.environ.get("EVENTLOOM_TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shown, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, duck, name):
    df = REGISTRY[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    spark_types = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    assert sorted(df.dtypes) == sorted((d[0], spark_types.get(str(d[1]), str(d[1]))) for d in cursor.description)
    expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert len(got[1]) > 0
    assert got[1] == expected[1]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    compare(spark, duck, name)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)
