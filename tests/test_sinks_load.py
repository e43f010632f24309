"""Table sink, pruned scan, audit, and the end-to-end load with its invariants."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from staylake.errors import UnsupportedWriteMode
from staylake.operators.audit import audit, breakdown_by, describe_table, row_count, sample_rows
from staylake.plans.load import run_load
from staylake.plans.mapping import map_bookings, transform_sample
from staylake.plans.queries import CORRUPT_EVERY, _database
from staylake.sinks.table import scan_bookings, table_history, write_table
from staylake.sources import tpch_bookings as fx

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def mapped(spark, lookups):
    return map_bookings(fx.raw_bookings(spark, SF_SMALL), lookups)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_overwrite_twice_equals_once_and_append_doubles(spark, mapped):
    table = f"{_database(spark, 't')}.bookings"
    n = mapped.count()
    r1 = write_table(mapped, table, "overwrite")
    assert r1.rows_written == n
    once = _rows(spark.table(table))
    write_table(mapped, table, "overwrite")
    assert _rows(spark.table(table)) == once
    write_table(mapped, table, "append")
    assert spark.table(table).count() == 2 * n
    hist = [(r["mode"], r["rows_written"]) for r in table_history(spark, table).collect()]
    assert hist == [("overwrite", n), ("overwrite", n), ("append", n)]


def test_table_by_name_keeps_values(spark, mapped):
    table = f"{_database(spark, 't')}.bookings"
    write_table(mapped, table, "overwrite")
    back = spark.table(table).drop("check_in_month").select(*mapped.columns)
    assert _rows(back) == _rows(mapped)
    assert spark.table(table).where("check_in_month <> trunc(check_in_date, 'MM')").count() == 0


def test_unsupported_mode_refused_before_ddl(spark, mapped):
    db = _database(spark, "t")
    with pytest.raises(UnsupportedWriteMode):
        write_table(mapped, f"{db}.never", "merge")
    assert not spark.catalog.tableExists(f"{db}.never")


def test_pruned_scan_filters_partitions(spark, mapped):
    table = f"{_database(spark, 't')}.bookings"
    write_table(mapped, table, "overwrite")
    scan = scan_bookings(spark, table, "1995-03-15", "1996-08-31", ["ASIA", "other"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "check_in_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    expected = mapped.where(
        (F.col("check_in_date") >= "1995-03-15") & (F.col("check_in_date") <= "1996-08-31") & F.col("region").isin("ASIA", "other")
    )
    assert _rows(scan.drop("check_in_month").select(*mapped.columns)) == _rows(expected)


def test_audit_suite(spark, mapped):
    table = f"{_database(spark, 't')}.bookings"
    write_table(mapped, table, "overwrite")
    checks = audit(spark, table)
    n = mapped.count()
    assert checks["row_count"].first()["cnt"] == n
    assert sum(r["bookings"] for r in checks["by_region"].collect()) == n
    assert sum(r["bookings"] for r in checks["by_status"].collect()) == n
    assert checks["sample"].count() == 5
    assert [r["col_name"] for r in checks["schema"].collect()][-2:] == ["check_in_month", "region"]
    assert checks["history"].count() == 1


def test_breakdown_validates_column(spark, mapped):
    with pytest.raises(ValueError):
        breakdown_by(mapped, "region; DROP TABLE x")
    top = breakdown_by(mapped, "status", n=2).collect()
    assert len(top) == 2 and top[0]["bookings"] >= top[1]["bookings"]


def test_row_count_and_sample(spark, mapped):
    assert row_count(mapped).first()["cnt"] == mapped.count()
    ids = [r["transaction_id"] for r in sample_rows(mapped, 3, "transaction_id").collect()]
    assert ids == sorted(ids)


def test_describe_table(spark, mapped):
    table = f"{_database(spark, 't')}.bookings"
    write_table(mapped, table, "overwrite")
    rows = describe_table(spark, table).collect()
    assert len(rows) == 16 and rows[-1]["is_partition"] and rows[0]["col_name"] == "transaction_id"


def test_run_load_invariants(spark, lookups, scratch):
    src = scratch + "/src"
    fx.booking_json_lines(spark, SF_SMALL, corrupt_every=CORRUPT_EVERY).write.text(src)
    table = f"{_database(spark, 'load')}.bookings"
    rep = run_load(spark, src, lookups, table, "overwrite")
    total = fx.table(spark, SF_SMALL, "orders").count()
    corrupt = fx.table(spark, SF_SMALL, "orders").where(F.col("o_orderkey") % CORRUPT_EVERY == 0).count()
    assert rep.rows_read == total
    assert rep.rows_rejected == corrupt
    assert rep.rows_written == total - corrupt
    assert rep.rows_read == rep.rows_written + rep.rows_rejected
    assert spark.table(table).count() == rep.rows_written
    rejects = spark.table(table + "_rejects").where(F.col("run_id") == rep.run_id)
    assert rejects.count() == corrupt
    assert rejects.where("reason = 'malformed_json' AND raw IS NOT NULL").count() == corrupt
    hist = table_history(spark, table).collect()
    assert [(r["rows_written"], r["rows_rejected"]) for r in hist] == [(rep.rows_written, corrupt)]


def test_transform_sample(spark, lookups):
    raw = fx.raw_bookings(spark, SF_SMALL)
    sample = transform_sample(raw, lookups, n=10, key="id")
    assert sample.count() == 10
    first_ids = sorted(r["id"] for r in raw.select("id").collect())[:10]
    assert sorted(r["transaction_id"] for r in sample.collect()) == first_ids


def test_sanity_table_insert_values(spark):
    """The catalog takes a table, literal rows and a read."""
    db = _database(spark, "smoke")
    spark.sql(f"CREATE TABLE {db}.rooms (floor INT, view STRING) USING parquet")
    spark.sql(f"INSERT INTO {db}.rooms VALUES (3, 'garden'), (7, 'sea')")
    assert sorted(tuple(r) for r in spark.table(f"{db}.rooms").collect()) == [(3, "garden"), (7, "sea")]


def test_overwrite_replaces_all_in_a_dynamic_session(spark, mapped):
    table = f"{_database(spark, 'dyn')}.bookings"
    write_table(mapped, table, "overwrite")
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        part = mapped.where("region = 'ASIA'")
        write_table(part, table, "overwrite")
        assert spark.conf.get(key) == "dynamic"
    finally:
        spark.conf.unset(key)
    assert spark.table(table).count() == part.count() < mapped.count()


def test_history_has_one_name_per_table_and_true_times(spark, mapped):
    import datetime as dt
    import os
    import time

    table = f"{_database(spark, 'names')}.bookings"
    zone = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        write_table(mapped.limit(3), f"spark_catalog.{table}", "overwrite")
        at = table_history(spark, table).select(F.col("committed_at").cast("long").alias("t")).collect()
    finally:
        os.environ.pop("TZ") if zone is None else os.environ.__setitem__("TZ", zone)
        time.tzset()
    assert len(at) == 1
    assert abs(at[0]["t"] - dt.datetime.now(dt.timezone.utc).timestamp()) < 600


def test_names_are_quoted(spark, mapped):
    db = _database(spark, "quote")
    write_table(mapped.limit(2), f"{db}.2nd", "overwrite", history=False)
    assert spark.table(f"{db}.`2nd`").count() == 2


def test_breakdown_is_complete_by_default(spark):
    df = spark.createDataFrame([(i % 100,) for i in range(1000)], "v int")
    assert breakdown_by(df, "v").count() == 100


def test_run_load_with_run_id_is_not_repeated(spark, lookups, scratch):
    src = scratch + "/src"
    fx.booking_json_lines(spark, SF_SMALL).write.text(src)
    table = f"{_database(spark, 'rerun')}.bookings"
    first = run_load(spark, src, lookups, table, "append", run_id="2026-09-15")
    again = run_load(spark, src, lookups, table, "append", run_id="2026-09-15")
    assert again == first
    assert spark.table(table).count() == first.rows_written
    assert [r["run_id"] for r in table_history(spark, table).collect()] == ["2026-09-15"]


def test_overwrite_from_itself_is_refused(spark, mapped):
    table = f"{_database(spark, 'self')}.bookings"
    write_table(mapped, table, "overwrite")
    with pytest.raises(Exception):
        write_table(spark.table(table).drop("check_in_month"), table, "overwrite")
    assert spark.table(table).count() == mapped.count()


def test_unordered_samples_take_any_n(spark, lookups, mapped):
    raw = fx.raw_bookings(spark, SF_SMALL)
    assert transform_sample(raw, lookups, n=7, key=None).count() == 7
    assert sample_rows(mapped, 4).count() == 4


def test_hot_partition_value_is_split_over_tasks(spark, mapped):
    """A month x region holding a third of all rows is written by several tasks."""
    import glob

    hot = mapped.withColumn(
        "region", F.when(F.col("transaction_id").cast("bigint") % 3 == 0, F.lit("HOT")).otherwise(F.col("region"))
    ).withColumn(
        "check_in_date", F.when(F.col("region") == "HOT", F.lit("1996-01-10").cast("date")).otherwise(F.col("check_in_date"))
    )
    hot = hot.unionByName(hot).unionByName(hot).unionByName(hot)
    table = f"{_database(spark, 'skew')}.bookings"
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_table(hot, table, "overwrite")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    files = glob.glob(location.removeprefix("file:") + "/check_in_month=1996-01-01/region=HOT/*.parquet")
    assert len(files) > 1
    assert spark.table(table).where("region = 'HOT'").count() == hot.where("region = 'HOT'").count()


def test_scan_bounds_one_sided_and_regions_only(spark, mapped):
    table = f"{_database(spark, 'scan')}.bookings"
    write_table(mapped, table, "overwrite")
    after = scan_bookings(spark, table, date_from="1997-01-01")
    assert after.count() == mapped.where("check_in_date >= DATE '1997-01-01'").count()
    before = scan_bookings(spark, table, date_to="1993-06-30")
    assert before.count() == mapped.where("check_in_date <= DATE '1993-06-30'").count()
    other = scan_bookings(spark, table, regions=["other"])
    assert other.count() == mapped.where("region = 'other'").count()


def test_breakdown_ties_and_nulls_are_deterministic(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", None, "b", "a", None, "c"]], "v string")
    got = [(r["v"], r["bookings"]) for r in breakdown_by(df, "v", n=3).collect()]
    assert got == [(None, 2), ("a", 2), ("b", 2)]


@pytest.mark.parametrize("source_format", ["json_array_whole", "json_array_lines"])
def test_run_load_from_array_files(spark, lookups, source_format):
    from staylake.plans.queries import _write_array_files

    src = _write_array_files(spark, SF_SMALL)
    table = f"{_database(spark, 'arr')}.bookings"
    rep = run_load(spark, src, lookups, table, "overwrite", source_format=source_format)
    total = fx.table(spark, SF_SMALL, "orders").count()
    assert (rep.rows_read, rep.rows_written, rep.rows_rejected) == (total, total, 0)
    assert spark.table(table).count() == total


def test_existing_table_with_other_layout_is_refused(spark, mapped):
    from staylake.errors import TableLayoutError

    db = _database(spark, "layout")
    spark.sql(f"CREATE TABLE {db}.bookings (transaction_id STRING, region STRING) USING parquet")
    with pytest.raises(TableLayoutError):
        write_table(mapped, f"{db}.bookings", "append")
