"""Audit answers from the runs' own counts, without a scan of the bookings.

Each load leaves the counts of its rows by region, status, device and country
(``SUMMARY``). Counts of runs add up, so the row count and the breakdowns of a
table are sums over the runs since its last overwrite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.operators.audit import breakdown_by, row_count
from staylake.schemas import SUMMARY_KEYS
from staylake.sinks.table import _quoted, history_table_for, summaries_table_for, table_history


def current_runs(spark: SparkSession, table: str) -> DataFrame:
    """``run_id, rows_written`` of the runs whose rows the table holds: the last overwrite and what was appended since."""
    history = table_history(spark, table)
    last = history.where("mode = 'overwrite'").agg(F.max("committed_at").alias("since"))
    runs = history.join(F.broadcast(last), (F.col("since").isNull()) | (F.col("committed_at") >= F.col("since")))
    return runs.select("run_id", "rows_written")


def table_summary(spark: SparkSession, table: str) -> DataFrame | None:
    """``region, status, device, country_code, bookings`` of the whole table, None where runs have left no counts.

    Runs of ``write_table`` leave none. The counts are held against the
    rows that the history says were written.
    """
    summaries = summaries_table_for(table)
    if not (spark.catalog.tableExists(summaries) and spark.catalog.tableExists(history_table_for(table))):
        return None
    runs = current_runs(spark, table)
    parts = spark.table(_quoted(summaries)).join(runs.select("run_id"), "run_id", "left_semi")
    known = parts.groupBy("run_id").agg(F.sum("bookings").alias("n"))
    missing = runs.join(known, "run_id", "left").where("rows_written > coalesce(n, 0)").limit(1).count()
    if missing:
        return None
    return parts.groupBy(*SUMMARY_KEYS).agg(F.sum("bookings").cast("long").alias("bookings"))


def audit_counts(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """``row_count`` and breakdowns ``by_<column>`` of a table, from its summaries or else by a scan."""
    summary = table_summary(spark, table)
    if summary is None:
        df = spark.table(_quoted(table))
        return {"row_count": row_count(df), **{f"by_{c}": breakdown_by(df, c) for c in SUMMARY_KEYS}}
    total = summary.agg(F.coalesce(F.sum("bookings"), F.lit(0)).cast("long").alias("cnt"))
    by = {
        f"by_{c}": summary.groupBy(c).agg(F.sum("bookings").cast("long").alias("bookings")).orderBy(F.desc("bookings"), F.asc_nulls_first(c))
        for c in SUMMARY_KEYS
    }
    return {"row_count": total, **by}
