"""Every query with check SQL equals DuckDB on the driver's smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return f"{value + 0.0:.8g}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches(spark, sf_dir, duck, name):
    got = contract.queries()[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    ours = _rows(got.columns, [tuple(r) for r in got.collect()])
    theirs = _rows(columns, cursor.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert contract.entry(spark).count() > 0
