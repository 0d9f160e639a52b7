"""Every registered query against its SQL on the test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value + 0.0)
    return "NULL" if value is None else str(value)


def table_of(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert got, f"{name} gives no rows"
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return
    relation = duck.sql(sql)
    assert sorted(df.columns) == sorted(relation.columns)
    types = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE"}
    assert {c: types[t] for c, t in df.dtypes} == dict(zip(relation.columns, map(str, relation.types)))
    expected = table_of(relation.columns, relation.fetchall())
    mine = table_of(df.columns, got)
    wrong = [(a, b) for a, b in zip(mine, expected) if a != b]
    assert len(mine) == len(expected) and not wrong, (len(mine), len(expected), wrong[:5])
