"""Every query against its SQL counterpart on the same tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from gantry.catalog import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def test_same_names():
    assert set(driver.queries()) >= set(driver.oracle_sql()) >= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    cursor = duck.execute(driver.oracle_sql()[name])
    expected_columns = [d[0] for d in cursor.description]
    assert columns == sorted(expected_columns)
    order = [expected_columns.index(c) for c in columns]
    expected = Counter(tuple(normal(row[i]) for i in order) for row in cursor.fetchall())
    actual = Counter(tuple(normal(v) for v in row) for row in result.select(columns).collect())
    assert sum(actual.values()) > 0
    assert actual == expected
