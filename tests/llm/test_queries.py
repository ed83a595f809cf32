"""Queries with SQL against DuckDB, as the driver compares them."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

from recordloom.llm import queries

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = sorted(tuple(r) for r in df.select(*columns).collect())
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})")
    described = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == described
    assert rows == sorted(result.fetchall())
