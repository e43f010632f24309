"""Driver contract: entry runs, queries and oracle keys line up."""

from __future__ import annotations

import __spark_entry__ as E
from staylake.schemas import MAPPED_BOOKING


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in MAPPED_BOOKING]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_every_booking_query_has_an_oracle():
    """Training-data queries that SQL cannot express are held to brute force in their own tests."""
    assert set(E.queries()) - set(E.oracle_sql()) <= set(E.LLM_QUERIES)
