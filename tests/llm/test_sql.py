"""Queries against their SQL statements in DuckDB."""

import os

import duckdb
import pytest

from eventloom.llm.oracles import ORACLES
from eventloom.llm.queries import REGISTRY

SF_DIR = os.environ.get("EVENTLOOM_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    df = REGISTRY[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in at)) for r in cursor.fetchall())
    assert len(got) > 0
    assert got == want
    types = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    assert sorted(df.dtypes) == sorted((d[0], types[str(d[1])]) for d in cursor.description)
