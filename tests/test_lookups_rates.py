"""Lookups (hit-flag semantics, key checks, broadcast choice) and rates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from staylake.errors import LookupKeyError
from staylake.operators.lookups import check_lookup, lookup_or_default, lookup_or_keep
from staylake.operators.rates import all_usd_rates, convert_amount, missing_rates, usd_rates, wanted_currencies
from staylake.schemas import QUOTES
from staylake.sources.mappings import mapping_from_dict


def test_lookup_or_keep_present_null_value_gives_null(spark):
    m = mapping_from_dict(spark, {"F": "confirmed", "P": None})
    df = spark.createDataFrame([("F",), ("P",), ("X",), (None,)], "s string")
    got = {r["s"]: r["o"] for r in lookup_or_keep(df, F.col("s"), m, "o").collect()}
    assert got == {"F": "confirmed", "P": None, "X": "X", None: None}


def test_lookup_or_default(spark):
    m = mapping_from_dict(spark, {"NL": "EUROPE", "XX": None})
    df = spark.createDataFrame([("NL",), ("XX",), ("ZZ",), (None,)], "c string")
    got = {r["c"]: r["o"] for r in lookup_or_default(df, F.col("c"), m, "o", "other").collect()}
    assert got == {"NL": "EUROPE", "XX": None, "ZZ": "other", None: "other"}


def test_lookup_never_changes_row_count(spark):
    m = mapping_from_dict(spark, {"a": "1", "b": "2"})
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"))
    assert lookup_or_keep(df, F.col("k"), m, "o").count() == 1000


def test_duplicate_keys_are_refused(spark):
    m = spark.createDataFrame([("a", "1"), ("a", "2")], "key string, value string")
    with pytest.raises(LookupKeyError):
        check_lookup(m)


def test_broadcast_only_below_size_limit(spark):
    m = spark.range(50).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    assert check_lookup(m, max_broadcast_rows=100).broadcast
    big = check_lookup(m, max_broadcast_rows=10)
    assert not big.broadcast
    df = spark.range(200).select((F.col("id") % 60).cast("string").alias("k"))
    out = lookup_or_keep(df, F.col("k"), big, "o")
    # Over the limit there is no broadcast hint; the join still gives every row.
    assert out.where("o = 'v'").count() == 170  # ids 0..199 mod 60 below 50
    assert out.count() == 200


def test_broadcast_join_in_plan(spark, lookups):
    from staylake.plans.mapping import map_bookings
    from staylake.sources import tpch_bookings as fx

    from tests.conftest import SF_SMALL

    plan = map_bookings(fx.raw_bookings(spark, SF_SMALL), lookups)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
        assert python_node not in plan


def _quotes(spark, items):
    return spark.createDataFrame(items, QUOTES)


def test_usd_rates_rules(spark):
    quotes = _quotes(spark, [("EUR", 0.8), ("GBP", 0.5), ("CHF", 0.0), ("USD", 1.0)])
    wanted = wanted_currencies(spark.createDataFrame([("eur",), ("CHF",), ("",), (None,), ("ZZZ",)], "c string"), "c")
    got = {r["currency"]: r["rate_to_usd"] for r in usd_rates(quotes, wanted).collect()}
    assert got == {"EUR": 1.25, "USD": 1.0}
    assert sorted(r["currency"] for r in missing_rates(wanted, usd_rates(quotes, wanted)).collect()) == ["CHF", "ZZZ"]


def test_usd_rates_nothing_wanted_gives_nothing(spark):
    quotes = _quotes(spark, [("EUR", 0.8)])
    wanted = wanted_currencies(spark.createDataFrame([(None,), ("",)], "c string"), "c")
    assert usd_rates(quotes, wanted).count() == 0


def test_usd_rates_only_usd(spark):
    quotes = _quotes(spark, [("EUR", 0.8)])
    wanted = wanted_currencies(spark.createDataFrame([("usd",)], "c string"), "c")
    assert [tuple(r) for r in usd_rates(quotes, wanted).collect()] == [("USD", 1.0)]


def test_all_usd_rates_equal_wanted_rates_for_bookings(spark):
    quotes = _quotes(spark, [("EUR", 0.8), ("GBP", 0.5), ("CHF", 0.0)])
    bookings = spark.createDataFrame([(10.0, "eur"), (3.0, "usd"), (5.0, "CHF"), (7.0, None), (1.0, "")], "a double, c string")
    wanted = wanted_currencies(bookings, "c")
    a = convert_amount(bookings, F.col("a"), F.col("c"), usd_rates(quotes, wanted), "u")
    b = convert_amount(bookings, F.col("a"), F.col("c"), all_usd_rates(quotes), "u")
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert {r["c"]: r["u"] for r in b.collect()} == {"eur": 12.5, "usd": 3.0, "CHF": None, None: None, "": None}


def test_missing_and_rated_partition_the_wanted_set(spark):
    quotes = _quotes(spark, [("EUR", 0.8), ("GBP", 0.0), ("JPY", 150.0)])
    bookings = spark.createDataFrame([(c,) for c in ["eur", "GBP", "usd", "zzz", "JPY", None, ""]], "c string")
    wanted = wanted_currencies(bookings, "c")
    rates = usd_rates(quotes, wanted)
    rated = {r["currency"] for r in rates.collect()}
    missing = {r["currency"] for r in missing_rates(wanted, rates).collect()}
    assert rated & missing == set()
    assert rated | missing == {r["currency"] for r in wanted.collect()}
    assert missing == {r["currency"] for r in missing_rates(wanted, all_usd_rates(quotes)).collect()} == {"GBP", "ZZZ"}


def test_byte_bound_and_local_materialisation(spark):
    m = spark.range(100).select(F.col("id").cast("string").alias("key"), F.repeat(F.lit("x"), 1000).alias("value"))
    small = check_lookup(m, max_broadcast_rows=1000, max_broadcast_bytes=10_000_000)
    assert small.broadcast and small.approx_bytes > 100_000
    assert "LocalRelation" in small.frame._jdf.queryExecution().optimizedPlan().toString()
    big = check_lookup(m, max_broadcast_rows=1000, max_broadcast_bytes=50_000)
    assert not big.broadcast
    df = spark.range(300).select((F.col("id") % 150).cast("string").alias("k"))
    assert lookup_or_keep(df, F.col("k"), small, "o").where("o = k").count() == 100
    assert lookup_or_keep(df, F.col("k"), big, "o").where("o = k").count() == 100
