"""Field builders: safe nested access, dates, country codes, prefixed ids, money."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staylake.functions.fields import country_code, date_only, prefixed_id, safe_path
from staylake.functions.money import invert_quote, to_usd


def test_safe_path_walks_structs_only(spark):
    df = spark.createDataFrame(
        [({"x": {"y": "v"}}, [{"y": "a"}], "s")],
        "a struct<x: struct<y: string>>, arr array<struct<y: string>>, s string",
    )
    row = df.select(
        safe_path(df, "a.x.y").alias("ok"),
        safe_path(df, "a.x.z").alias("missing"),
        safe_path(df, "arr.y").alias("through_array"),
        safe_path(df, "s.y").alias("through_scalar"),
        safe_path(df, "A.x.y").alias("case_sensitive"),
    ).first()
    assert row.asDict() == {"ok": "v", "missing": None, "through_array": None, "through_scalar": None, "case_sensitive": None}


def test_safe_path_null_parent(spark):
    df = spark.createDataFrame([(None,)], "a struct<x: string>")
    assert df.select(safe_path(df, "a.x").alias("v")).first()["v"] is None


def test_date_only_edges(spark):
    values = ["2026-09-15T14:00:00Z", "2026-13-01", "abc", "", "2026-9-5", "2026-09-15 10:00", "T10:00", None]
    df = spark.createDataFrame([(v,) for v in values], "ts string")
    got = {r["ts"]: r["d"] for r in df.select("ts", date_only(F.col("ts")).alias("d")).collect()}
    assert got == {
        "2026-09-15T14:00:00Z": dt.date(2026, 9, 15),
        "2026-13-01": None,
        "abc": None,
        "": None,
        "2026-9-5": dt.date(2026, 9, 5),
        "2026-09-15 10:00": dt.date(2026, 9, 15),
        "T10:00": None,
        None: None,
    }


def test_country_code_and_prefixed_id(spark):
    df = spark.createDataFrame([("nl", "483720"), ("", None), (None, "0")], "c string, a string")
    got = df.select(country_code(F.col("c")).alias("cc"), prefixed_id(F.col("a")).alias("p")).collect()
    assert [(r["cc"], r["p"]) for r in got] == [("NL", "BC-483720"), (None, None), (None, "BC-0")]


def test_to_usd_rounds_half_up_in_decimal(spark):
    df = spark.createDataFrame([(2.675, 1.0), (0.125, 1.0), (1.005, 1.0), (100.0, None), (None, 1.5)], "a double, r double")
    got = [r["u"] for r in df.select(to_usd(F.col("a"), F.col("r")).alias("u")).collect()]
    assert got == [2.68, 0.13, 1.01, None, None]


def test_invert_quote_skips_zero_and_null(spark):
    df = spark.createDataFrame([(0.8,), (0.0,), (None,)], "q double")
    got = [r["r"] for r in df.select(invert_quote(F.col("q")).alias("r")).collect()]
    assert got == [1.25, None, None]


def test_to_usd_keeps_three_decimal_amounts(spark):
    df = spark.createDataFrame([(1.235, 3.25), (0.005, 1.0)], "a double, r double")
    got = [r["u"] for r in df.select(to_usd(F.col("a"), F.col("r")).alias("u")).collect()]
    # 1.235 * 3.25 = 4.01375 -> 4.01 (rounding the amount to cents first would give 1.24 * 3.25 = 4.03)
    assert got == [4.01, 0.01]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_to_usd_never_stops_other_rows(spark, ansi):
    rows = [(1, 2.0, 65_000.0), (2, 1e15, 1e-12), (3, 1e15, 2.0), (4, 3.0, float("nan")), (5, 1e300, 1e300), (6, 2.5, 1.0), (7, 1.0, 0.0)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(rows, "id int, a double, r double")
        got = {r["id"]: r["u"] for r in df.select("id", to_usd(F.col("a"), F.col("r")).alias("u")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got == {1: 130_000.0, 2: 1000.0, 3: 2e15, 4: None, 5: None, 6: 2.5, 7: 0.0}
