"""Schema drift, counts that add up, and lookups whatever the skew."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from staylake.operators.audit import breakdown_by
from staylake.operators.drift import drift_profile
from staylake.operators.lookups import check_lookup, frequent_keys, lookup_or_default, lookup_or_keep
from staylake.operators.summaries import audit_counts, table_summary
from staylake.plans.load import load_parsed
from staylake.plans.queries import _database
from staylake.schemas import SUMMARY_KEYS
from staylake.sinks.table import write_table
from staylake.sources import tpch_bookings as fx
from staylake.sources.json_lines import parse_json_lines

from tests.conftest import SF_SMALL


def test_drift_names_unknown_and_retyped_fields(spark):
    lines = [
        '{"id":1,"label":"a","booker":{"address":{"country":"x","city":"y"}},"rooms":[{"n":1}]}',
        '{"id":2,"label":{"a":1},"rooms":[],"booker":5,"new field":{"deep":true}}',
        '{"id":3,"label":["a"],"rooms":null,"accommodations":[1],"it\'s":1.5}',
        '{"id":4,"booker":{"address":"none"},"new field":"text"}',
        "{broken",
        "[1]",
        "5",
    ]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    got = {(r["path"], r["expected"], r["found"]): r["records"] for r in drift_profile(df).collect()}
    assert got == {
        ("rooms", None, "ARRAY"): 2,
        ("booker", "OBJECT", "BIGINT"): 1,
        ("new field", None, "OBJECT"): 1,
        ("new field", None, "STRING"): 1,
        ("label", "SCALAR", "OBJECT"): 1,
        ("label", "SCALAR", "ARRAY"): 1,
        ("accommodations", "OBJECT", "ARRAY"): 1,
        ("it's", None, "DECIMAL"): 1,
    }
    nested = spark.createDataFrame([(lines[0],), ('{"booker":{"address":{"city":7}}}',)], "value string")
    assert {(r["path"], r["found"]): r["records"] for r in drift_profile(nested).collect()} == {
        ("booker.address.city", "STRING"): 1,
        ("booker.address.city", "BIGINT"): 1,
        ("rooms", "ARRAY"): 1,
    }
    assert drift_profile(df.limit(0)).count() == 0
    assert drift_profile(fx.booking_json_lines(spark, SF_SMALL)).count() == 0


def test_counts_of_runs_add_up_without_a_scan(spark, lookups):
    table = f"{_database(spark, 'sum')}.bookings"
    parsed = parse_json_lines(fx.booking_json_lines(spark, SF_SMALL, corrupt_every=37))
    some = parsed.where("pmod(xxhash64(value), 10) < 3")
    for k, (rows, mode) in enumerate(((parsed, "append"), (parsed, "overwrite"), (some, "append"), (some, "append"))):
        load_parsed(rows, lookups, table, mode, f"run/{k} %")
        got = audit_counts(spark, table)
        df = spark.table(table)
        assert got["row_count"].first()["cnt"] == df.count()
        for c in SUMMARY_KEYS:
            want = [tuple(r) for r in breakdown_by(df, c).collect()]
            assert [tuple(r) for r in got[f"by_{c}"].collect()] == want
    plan = got["by_region"]._jdf.queryExecution().executedPlan().toString()
    assert "bookings_summaries" in plan and ".bookings[" not in plan
    write_table(df.drop("check_in_month").limit(5), table, "append")  # leaves no counts: they are taken by a scan
    assert table_summary(spark, table) is None
    assert audit_counts(spark, table)["row_count"].first()["cnt"] == spark.table(table).count()


@pytest.fixture()
def aqe_off(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_does_not_fill_a_task(spark, aqe_off):
    """Nine tenths of the rows have one key, of the rest some have none: every task gets its share."""
    key = F.when(F.col("id") % 10 != 0, F.lit("hot")).when(F.col("id") % 50 != 0, F.concat(F.lit("k"), F.col("id") % 3000))
    df = spark.range(40_000).select("id", key.alias("code"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    pairs = spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.concat(F.lit("v"), F.col("id")).alias("value"))
    pairs = pairs.unionByName(spark.createDataFrame([("hot", None), ("cold", "c")], "key string, value string"))
    large = check_lookup(pairs, max_broadcast_rows=10)
    assert not large.broadcast and frequent_keys(df, F.col("code")) == ["hot"]
    out = lookup_or_default(df, F.col("code"), large, "name", "none")
    assert out.columns == ["id", "code", "m", "name"]
    sizes = Counter(r["p"] for r in out.select(F.spark_partition_id().alias("p")).collect())
    ordered = sorted(sizes.values())
    assert len(sizes) == 8 and ordered[-1] <= 2 * ordered[len(ordered) // 2]
    small = lookup_or_default(df, F.col("code"), check_lookup(pairs), "name", "none")
    key_of = lambda r: r["id"]
    assert sorted(out.drop("m").collect(), key=key_of) == sorted(small.drop("m").collect(), key=key_of)
    kept = lookup_or_keep(df, F.col("code"), large, "code").groupBy("code").count().collect()
    assert {r["code"]: r["count"] for r in kept}[None] == 36_000 + 800
