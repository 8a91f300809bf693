"""Every query with an SQL twin gives the same columns, types and rows as the twin."""

import math
from datetime import datetime

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from netload.plans.catalog import QUERIES
from netload.plans.oracles import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value.isoformat() if isinstance(value, datetime) else str(value)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    rows = frame.collect()
    twin = duck.execute(ORACLES[name])
    twin_types = {d[0]: str(d[1]) for d in twin.description}
    assert {c: TYPES[t] for c, t in frame.dtypes} == twin_types
    assert _rows(rows, frame.columns) == _rows(twin.fetchall(), list(twin_types))


def test_every_query_has_a_twin_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
