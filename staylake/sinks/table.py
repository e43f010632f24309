"""Bookings table: create, write (overwrite / append), scan, history.

The table is parquet in the session catalog, partitioned by
``(check_in_month, region)``; ``check_in_month`` is the first day of the
check-in month, derived on write, because parquet tables take plain
partition columns only.

Writes are by column name (the DataFrame is reordered to the table's own
column order, which puts partition columns last), count their rows with an
observation on the same pass, and are clustered by partition value before
the write with a ``rebalance`` hint: AQE then sizes the write tasks and
splits a partition value that holds a large share of the rows over several
tasks instead of one. Without AQE that hint would be a plain hash
repartition, sending a hot partition value to a single task, so then the
input tasks write their own files instead (more files, no hot task).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from staylake.errors import TableLayoutError, UnsupportedWriteMode
from staylake.functions.fields import month_of
from staylake.schemas import BOOKINGS_TABLE, PARTITION_COLUMNS, REJECT_TABLE, RUN_HISTORY

WRITE_MODES = ("overwrite", "append")


@dataclass(frozen=True)
class WriteResult:
    run_id: str
    table: str
    mode: str
    rows_written: int


def _ddl_columns(schema) -> str:
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def _database_of(table: str) -> str | None:
    parts = table.split(".")
    return ".".join(parts[:-1]) if len(parts) > 1 else None


def _quoted(name: str) -> str:
    """A dotted name with every part in backticks, safe inside SQL text."""
    parts = [p[1:-1] if len(p) > 1 and p[0] == p[-1] == "`" else p for p in name.split(".")]
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def canonical_name(spark: SparkSession, table: str) -> str:
    """One name for a table however it is written: ``database.table`` in the session catalog."""
    parts = [p.strip("`") for p in table.split(".")]
    if len(parts) == 3 and parts[0] == "spark_catalog":
        parts = parts[1:]
    if len(parts) == 1:
        parts = [spark.catalog.currentDatabase(), *parts]
    return ".".join(parts)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``; ``location`` should be shared storage."""
    where = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{where}")


def ensure_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the bookings table if absent, partitioned by month and region."""
    db = _database_of(table)
    if db:
        ensure_database(spark, db)
    where = f"\nLOCATION {_literal(location)}" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} (\n  {_ddl_columns(BOOKINGS_TABLE)}\n)\n"
        f"USING parquet\nPARTITIONED BY ({', '.join(PARTITION_COLUMNS)}){where}"
    )


def ensure_side_table(spark: SparkSession, table: str, schema, partition: str | None = None) -> None:
    """Create a parquet table (history, rejects, summaries) if absent."""
    db = _database_of(table)
    if db:
        ensure_database(spark, db)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(table)} (\n  {_ddl_columns(schema)}\n) USING parquet" + (f" PARTITIONED BY ({partition})" if partition else ""))


def history_table_for(table: str) -> str:
    db = _database_of(table)
    return f"{db}.run_history" if db else "run_history"


def summaries_table_for(table: str) -> str:
    return f"{table}_summaries"


def rejects_table_for(table: str) -> str:
    return f"{table}_rejects"


def _prepared(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Derive the month column and reorder to the table's columns, by name."""
    with_month = df.withColumn("check_in_month", month_of(F.col("check_in_date")))
    target = spark.table(_quoted(table)).schema
    have = {(f.name, f.dataType.simpleString()) for f in target.fields}
    want = {(f.name, f.dataType.simpleString()) for f in BOOKINGS_TABLE.fields}
    if have != want:
        raise TableLayoutError(
            f"table {table} does not have the bookings layout: missing {sorted(want - have)}, unexpected {sorted(have - want)}"
        )
    return with_month.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])


def _aqe_on(spark: SparkSession) -> bool:
    return str(spark.conf.get("spark.sql.adaptive.enabled", "true")).lower() == "true"


def _insert(df: DataFrame, table: str, overwrite: bool) -> None:
    """Insert by position; an overwrite replaces the whole table whatever the session's mode.

    The writer has no option for it: in a session with dynamic partition
    overwrite, partitions without new rows would stay. The setting is put
    back afterwards.
    """
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key, "static") if overwrite else "static"
    if before.lower() == "static":
        df.write.insertInto(_quoted(table), overwrite=overwrite)
        return
    conf.set(key, "static")
    try:
        df.write.insertInto(_quoted(table), overwrite=True)
    finally:
        conf.set(key, before)


def clustered(rows: DataFrame, *front: str) -> DataFrame:
    """Rows dealt by partition value and sorted by check-in date within it.

    The sort is one with the one that the writer needs, so that the row groups
    of a file hold a range of dates each, and a scan of a few days skips the others.
    """
    return rows.hint("rebalance", *front, *PARTITION_COLUMNS).sortWithinPartitions(*front, *PARTITION_COLUMNS, "check_in_date")


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    *,
    location: str | None = None,
    cluster: bool | None = None,
    history: bool = True,
    rows_rejected: int | None = None,
    run_id: str | None = None,
) -> WriteResult:
    """Write mapped bookings into ``table``.

    ``overwrite`` replaces all of the table's data; ``append`` adds rows. Any other mode is
    refused before anything is created. With ``history`` a row describing
    the run is appended to the database's ``run_history`` table after the
    data is committed. ``cluster`` defaults to on exactly when AQE is on.
    """
    if mode not in WRITE_MODES:
        raise UnsupportedWriteMode(f"write mode {mode!r} is not one of {WRITE_MODES}")
    spark = df.sparkSession
    ensure_table(spark, table, location)
    out = _prepared(spark, df, table)
    if cluster is None:
        cluster = _aqe_on(spark)
    if cluster:
        out = clustered(out)
    # Counted in the writing tasks (after the exchange): Spark applies a
    # finishing task's metrics once, so the count stays exact when a lost
    # executor makes earlier stages run again.
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    _insert(out, table, overwrite=(mode == "overwrite"))
    result = WriteResult(run_id or uuid.uuid4().hex, table, mode, int(obs.get["rows"]))
    if history:
        record_run(spark, result, rows_rejected)
    return result


def record_run(spark: SparkSession, result: WriteResult, rows_rejected: int | None) -> None:
    """Append one ``run_history`` row for a committed write; the history is partitioned by table."""
    hist = history_table_for(result.table)
    ensure_side_table(spark, hist, RUN_HISTORY, "`table`")
    name = canonical_name(spark, result.table)
    # An aware time: the instant is the same whatever zone the driver or the session is in.
    now = _dt.datetime.now(_dt.timezone.utc)
    row = [(result.run_id, now, name, result.mode, result.rows_written, rows_rejected)]
    history = spark.table(_quoted(hist)).columns
    _insert(spark.createDataFrame(row, RUN_HISTORY).select(*[F.col(f"`{c}`") for c in history]), hist, overwrite=False)


def write_rejects(rejects: DataFrame, table: str, run_id: str) -> int:
    """Append reject rows ``(id, reason, raw)`` tagged with ``run_id``; returns the count."""
    spark = rejects.sparkSession
    ensure_side_table(spark, table, REJECT_TABLE)
    obs = Observation(f"rejects_{uuid.uuid4().hex[:8]}")
    tagged = rejects.select("id", "reason", "raw", F.lit(run_id).alias("run_id")).observe(obs, F.count(F.lit(1)).alias("rows"))
    _insert(tagged, table, overwrite=False)
    return int(obs.get["rows"])


def table_history(spark: SparkSession, table: str, history_table: str | None = None) -> DataFrame:
    """Runs recorded for ``table``, oldest first."""
    hist = history_table or history_table_for(table)
    return spark.table(_quoted(hist)).where(F.col("table") == canonical_name(spark, table)).orderBy("committed_at", "run_id")


def scan_bookings(
    spark: SparkSession,
    table: str,
    date_from: str | _dt.date | None = None,
    date_to: str | _dt.date | None = None,
    regions: list[str] | None = None,
) -> DataFrame:
    """Bookings with check-in in ``[date_from, date_to]`` and region in ``regions``.

    The matching ``check_in_month`` bounds are added next to the date
    predicates, so only the partitions of the requested months and regions
    are listed and read.
    """
    df = spark.table(_quoted(table))
    if date_from is not None:
        lo = F.lit(date_from).cast("date")
        df = df.where((F.col("check_in_month") >= month_of(lo)) & (F.col("check_in_date") >= lo))
    if date_to is not None:
        hi = F.lit(date_to).cast("date")
        df = df.where((F.col("check_in_month") <= month_of(hi)) & (F.col("check_in_date") <= hi))
    if regions is not None:
        df = df.where(F.col("region").isin(list(regions)))
    return df


def scan_wanted(spark: SparkSession, table: str, wanted: DataFrame) -> DataFrame:
    """Bookings of the months and regions listed in ``wanted`` (``check_in_month, region``).

    Only the partitions of the listed pairs' months and regions are read
    (dynamic partition pruning); the list is broadcast if Spark finds it small.
    """
    pairs = wanted.select("check_in_month", "region").distinct()
    return spark.table(_quoted(table)).join(pairs, ["check_in_month", "region"], "left_semi")
