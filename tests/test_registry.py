"""Every registered query against its SQL, on one of the supplied folders."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from shelfline.registry import oracles
from shelfline.registry import queries as registered

from .conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/sf0.001/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_matches_sql(spark, duck, name):
    got = registered.queries()[name](spark, f"{DATA}/sf0.001")
    rows = [tuple(r) for r in got.collect()]
    assert rows
    want = duck.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert _rows(got.columns, rows) == _rows(names, want.fetchall())


def test_every_query_has_sql():
    assert set(SQL) == set(registered.queries())
    assert set(registered.queries()) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
