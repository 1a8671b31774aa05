"""Every registered query against its SQL, on the whole smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, (Decimal, float)):
        return None if math.isnan(value) else float(value)
    return value


def _sorted(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    assert _sorted(result.collect(), result.columns) == _sorted(expected.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["step", "rows_in", "rows_written", "rows_rejected", "sum_k"]
    first, second, table = result.orderBy("step").collect()
    assert first.rows_in == 1000 and first.rows_written + first.rows_rejected == 1000
    assert second.rows_in == 0 and table.rows_written == first.rows_written
