"""Every query that has SQL gives the rows of that SQL."""

import glob
import math
import os

import duckdb
import pytest

from sparkloom.plans.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return x


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, tables, name):
    made = QUERIES[name](spark, FOLDER)
    told = tables.sql(ORACLE_SQL[name])
    assert sorted(made.columns) == sorted(told.columns)
    assert rows(made.columns, [tuple(r) for r in made.collect()]) == rows(told.columns, told.fetchall())
