"""Every core query with SQL agrees with it on the smallest tables."""

from __future__ import annotations

import decimal
import os

import duckdb
import pytest

from lexstrata.plans import registry


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 9)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"create view {f[:-8]} as select * from '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, data, name):
    df = registry.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(registry.oracle_sql()[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == columns
    at = [found.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)
