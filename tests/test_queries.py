"""Every query with an SQL twin gives DuckDB's rows over the smallest tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from geoledger.plans import catalog
from tests.conftest import TABLES

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(TABLES).iterdir():
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(names: list[str], found: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    duck.execute(SQL[name])
    names = [d[0] for d in duck.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, duck.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
