"""Every registered query against its SQL twin in DuckDB, on the smallest given tables."""

import math
import os
import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no given tables here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return str(value)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, database, name):
    frame = queries()[name](spark, FOLDER)
    cursor = database.execute(oracle_sql()[name])
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    assert {c.name: KINDS.get(c.dataType.simpleString()) for c in frame.schema} == kinds
    order = sorted(kinds)
    names = [column[0] for column in cursor.description]
    want = sorted(tuple(text(row[names.index(k)]) for k in order) for row in cursor.fetchall())
    got = sorted(tuple(text(row[k]) for k in order) for row in frame.collect())
    assert got == want


def test_only_pipeline_operators_lack_sql():
    assert all(re.match(r"op[0-9]+_|pipeline$", name) for name in set(queries()) - set(oracle_sql()))


def test_entry(spark):
    assert entry(spark).count() > 0
