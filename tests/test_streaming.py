"""Incremental append: exactly-once on batch retry and on stream restart."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylake.plans.queries import _database
from staylake.sinks.commit import _Files
from staylake.sinks.table import table_history
from staylake.sources import tpch_bookings as fx
from staylake.sources.json_lines import read_json_lines
from staylake.streaming.incremental import append_batch, load_available

from tests.conftest import SF_SMALL


def test_retried_batch_is_not_appended_twice(spark, lookups, scratch):
    src = scratch + "/src"
    fx.booking_json_lines(spark, SF_SMALL, corrupt_every=37).write.text(src)
    batch = read_json_lines(spark, src)
    table = f"{_database(spark, 'retry')}.bookings"
    append_batch(batch, lookups, table, "stream-0")
    first = spark.table(table).count()
    append_batch(batch, lookups, table, "stream-0")  # the same batch, re-run
    assert spark.table(table).count() == first
    append_batch(batch, lookups, table, "stream-1")  # a new batch id appends
    assert spark.table(table).count() == 2 * first
    hist = table_history(spark, table).collect()
    assert [r["run_id"] for r in hist] == ["stream-0", "stream-1"]
    assert all(r["rows_rejected"] > 0 for r in hist)


def test_restart_only_loads_new_files(spark, lookups, scratch):
    src, ckpt = scratch + "/src", scratch + "/ckpt"
    lines = fx.booking_json_lines(spark, SF_SMALL)
    first, second = lines.randomSplit([0.5, 0.5], seed=3)
    first.write.text(src + "/a")
    table = f"{_database(spark, 'restart')}.bookings"
    load_available(spark, src + "/*", lookups, table, checkpoint_location=ckpt)
    n1 = spark.table(table).count()
    assert n1 == first.count()
    second.write.text(src + "/b")
    load_available(spark, src + "/*", lookups, table, checkpoint_location=ckpt)
    assert spark.table(table).count() == lines.count()
    assert sorted(r["rows_written"] for r in table_history(spark, table).collect()) == sorted([n1, second.count()])


def test_batches_of_a_stream_with_state_are_clustered(spark, lookups, scratch):
    """A batch writes a partition value in one file, whatever the state's tasks; one of repeated deliveries only is a run of no rows."""
    src = scratch + "/src"
    line = F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.lit("1996-03-02T00:00:00Z").alias("start"), F.struct(F.col("id").alias("reservation")).alias("accommodations")))
    rows = spark.range(300).coalesce(1).select(line.alias("value"))
    rows.write.text(src + "/a")
    rows.write.text(src + "/b")
    table = f"{_database(spark, 'clustered')}.bookings"
    query = load_available(
        spark, src + "/*", lookups, table, checkpoint_location=scratch + "/ckpt", max_files_per_trigger=1, duplicates_within="7 days"
    )
    assert query.exception() is None
    assert spark.table(table).count() == 300
    assert [r["rows_written"] for r in table_history(spark, table).collect()][:2] == [300, 0]
    assert len(spark.table(table).inputFiles()) == 1
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_a_move_lists_no_folder_of_files(spark, tmp_path):
    """Files join the ones of earlier runs unseen: what a partition holds already costs a commit nothing."""
    import os

    for place, name in (("src/p=1", "new"), ("dst/p=1", "old"), ("src/p=2", "new")):
        os.makedirs(f"{tmp_path}/{place}")
        open(f"{tmp_path}/{place}/{name}", "w").close()
    files, listed = _Files(spark, str(tmp_path)), []
    children = files.children
    files.children = lambda p: listed.append(p) or children(p)
    files.move_into(f"{tmp_path}/src", f"{tmp_path}/dst")
    assert sorted(os.listdir(f"{tmp_path}/dst/p=1")) == ["new", "old"] and os.listdir(f"{tmp_path}/dst/p=2") == ["new"]
    assert f"{tmp_path}/dst/p=1" not in listed
