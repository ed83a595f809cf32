"""Every query against the SQL that checks it, as the driver does."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_module
from recordloom.plans import catalogue

# The training-data queries are tested beside their operators.
QUERIES = {k: v for k, v in entry_module.queries().items() if k in catalogue.QUERIES}
ORACLES = {k: v for k, v in entry_module.oracle_sql().items() if k in catalogue.QUERIES}
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def sortable(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    if name not in ORACLES:
        return
    result = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in result.description}
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == described
    picked = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in picked) for r in result.fetchall()]
    assert sorted(map(sortable, rows)) == sorted(map(sortable, expected))


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_is_not_empty(spark):
    assert entry_module.entry(spark).count() > 0
