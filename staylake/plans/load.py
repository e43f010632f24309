"""End-to-end load: JSON -> parse -> tag rejects -> map -> tables.

One pass over the source: a single job writes booked and rejected rows into a
staging folder of the run, from which they are committed (see
``staylake.sinks.commit``). A load that is started again under its run id,
after a failure at any point, ends as if it had run once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from staylake.errors import UnsupportedWriteMode
from staylake.functions.fields import month_of
from staylake.operators.rejects import recovered_id, reject_reason
from staylake.plans.mapping import Lookups, map_bookings
from staylake.schemas import BOOKINGS_TABLE, CORRUPT_COLUMN
from staylake.sinks.commit import BAD, GOOD, KIND, forget, load_once
from staylake.sinks.table import (
    WRITE_MODES,
    WriteResult,
    canonical_name,
    history_table_for,
    record_run,
    rejects_table_for,
)
from staylake.sources.json_arrays import read_json_array
from staylake.sources.json_lines import read_json_lines

SOURCE_FORMATS = ("json_lines", "json_array_whole", "json_array_lines")


@dataclass(frozen=True)
class LoadReport:
    run_id: str
    rows_read: int
    rows_written: int
    rows_rejected: int
    table: str
    mode: str


def read_source(spark: SparkSession, path: str | list[str], source_format: str = "json_lines"):
    """Parsed raw records (``value`` + fields + ``_corrupt_record``) from any supported layout."""
    if source_format == "json_lines":
        return read_json_lines(spark, path)
    if source_format == "json_array_whole":
        return read_json_array(spark, path, layout="whole")
    if source_format == "json_array_lines":
        return read_json_array(spark, path, layout="lines")
    raise ValueError(f"unknown source format {source_format!r}; use one of {SOURCE_FORMATS}")


def committed_run(spark: SparkSession, table: str, run_id: str) -> LoadReport | None:
    """The recorded report of ``run_id`` for ``table``, or None when it never committed."""
    hist = history_table_for(table)
    if not spark.catalog.tableExists(hist):
        return None
    row = spark.table(hist).where((F.col("table") == canonical_name(spark, table)) & (F.col("run_id") == run_id)).limit(1).collect()
    if not row:
        return None
    r = row[0]
    rejected = int(r["rows_rejected"] or 0)
    return LoadReport(run_id, int(r["rows_written"]) + rejected, int(r["rows_written"]), rejected, table, r["mode"])


def tagged_rows(parsed: DataFrame, lookups: Lookups, run_id: str) -> DataFrame:
    """Parsed records as rows of the bookings table or of the rejects table, told by ``KIND``."""
    reason, rid, raw = (F.col(f"__load_{c}") for c in ("reason", "id", "raw"))
    tagged = parsed.select(
        *[F.col(f"`{c}`") for c in parsed.columns if c not in ("value", CORRUPT_COLUMN)],
        reject_reason(parsed).alias("__load_reason"),
        recovered_id(parsed).alias("__load_id"),
        F.col("value").alias("__load_raw"),
    )
    mapped = map_bookings(tagged, lookups, keep=("__load_reason", "__load_id", "__load_raw"))
    mapped = mapped.withColumn("check_in_month", month_of(F.col("check_in_date")))
    good = reason.isNull()
    return mapped.select(
        F.when(good, GOOD).otherwise(BAD).alias(KIND),
        *[F.when(good, F.col(f.name)).cast(f.dataType).alias(f.name) for f in BOOKINGS_TABLE.fields],
        F.when(~good, rid).alias("id"),
        reason.alias("reason"),
        F.when(~good, raw).alias("raw"),
        F.when(~good, F.lit(run_id)).alias("run_id"),
    )


def load_parsed(
    parsed: DataFrame, lookups: Lookups, table: str, mode: str, run_id: str, reject_table: str | None = None, location: str | None = None
) -> LoadReport:
    """Load parsed records under ``run_id``, once however often it is started."""
    if mode not in WRITE_MODES:
        raise UnsupportedWriteMode(f"write mode {mode!r} is not one of {WRITE_MODES}")
    spark = parsed.sparkSession
    done = committed_run(spark, table, run_id)
    if done is not None:
        forget(spark, table, run_id)
        return done
    read = Observation(f"read_{uuid.uuid4().hex[:8]}")
    counted = parsed.observe(read, F.count(F.lit(1)).alias("rows"))
    rejects = reject_table or rejects_table_for(table)
    staged = load_once(spark, lambda: tagged_rows(counted, lookups, run_id), table, mode, run_id, rejects, read, parsed.count, location)
    record_run(spark, WriteResult(run_id, table, mode, staged.rows_written), staged.rows_rejected)
    forget(spark, table, run_id)
    return LoadReport(run_id, staged.rows_read, staged.rows_written, staged.rows_rejected, table, mode)


def run_load(
    spark: SparkSession,
    path: str | list[str],
    lookups: Lookups,
    table: str,
    mode: str = "overwrite",
    *,
    source_format: str = "json_lines",
    location: str | None = None,
    reject_table: str | None = None,
    run_id: str | None = None,
) -> LoadReport:
    """Load raw booking JSON into ``table``; rejects go to ``reject_table``.

    ``rows_read`` is counted in the scan, and ``rows_read == rows_written +
    rows_rejected`` is checked before any table changes. The files to read
    are listed once. Pass a ``run_id`` that names the load (a batch date, a
    file set) to start it again after a failure: rows that are staged already
    are not read again, and a run in the table's history is not repeated;
    its recorded counts are returned.
    """
    run_id = run_id or uuid.uuid4().hex
    done = committed_run(spark, table, run_id)
    if done is not None:
        forget(spark, table, run_id)
        return done
    files = spark.read.text(path).inputFiles()
    parsed = read_source(spark, list(files) or path, source_format)
    return load_parsed(parsed, lookups, table, mode, run_id, reject_table, location)
