"""Every registered query against its DuckDB twin on the smallest tables."""

import glob
import math
import os

import pytest

import __spark_entry__ as driver

FOLDER = driver.SMOKE_FOLDER
ORACLES = driver.oracle_sql()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return ""
        return repr(float(value)) if isinstance(value, float) else str(value)

    return [names[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(name, spark, duck):
    df = driver.queries()[name](spark, FOLDER)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got[1], "no rows"
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        assert got == canonical([c[0] for c in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() == 5


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(driver.queries())
