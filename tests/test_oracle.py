"""Every registered query against its DuckDB oracle, on the smoke-scale tables.

The same comparison as ``tools/oracle_check.py`` (row count, column names,
types, order-insensitive values), run inside the test suite.
"""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, digest, type_mismatches  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    expected = rel.fetchall()
    assert len(rows) == len(expected)
    assert digest(df.columns, rows) == digest(list(rel.columns), expected)
    assert type_mismatches(df.schema.fields, {c: str(t) for c, t in zip(rel.columns, rel.types)}) == []
