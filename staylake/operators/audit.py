"""Read-only audit queries over the bookings table (or any DataFrame).

Each returns a DataFrame instead of printing, so callers can show, compare
or store the result. Column names are checked against the schema instead of
being pasted into SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _require_column(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"unknown column {column!r}; have {df.columns}")


def row_count(df: DataFrame) -> DataFrame:
    """One row, ``cnt``: number of rows."""
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def breakdown_by(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value of ``column``, most frequent first; all values, or the top ``n``.

    Ties are broken by the value itself (nulls first) so the cut at ``n`` is
    deterministic. The count is a partial (map-side) aggregate, so a value
    holding most rows costs no more than any other.
    """
    _require_column(df, column)
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("bookings"))
    ordered = counts.orderBy(F.desc("bookings"), F.asc_nulls_first(column))
    return ordered if n is None else ordered.limit(n)


def sample_rows(df: DataFrame, n: int = 5, order_by: str | list[str] | None = None) -> DataFrame:
    """``n`` rows: the first by ``order_by`` (a stable pick, per-task top-n over
    all rows), or with ``order_by=None`` any ``n`` (a limit that stops early)."""
    if order_by is None:
        return df.limit(n)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    for k in keys:
        _require_column(df, k)
    return df.orderBy(*[F.asc_nulls_first(k) for k in keys]).limit(n)


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """Schema of a catalog table: ``(position, col_name, data_type, is_partition)``."""
    cols = spark.catalog.listColumns(table)
    rows = [(i, c.name, c.dataType, bool(c.isPartition)) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "position int, col_name string, data_type string, is_partition boolean")


def column_profile(spark: SparkSession, table: str) -> DataFrame:
    """``position, col_name, data_type, stored_type, filled``: the table's columns beside what is stored.

    ``stored_type`` is the type that the files hold (of a partition column
    the catalog's), ``filled`` the rows with a value. One pass over the data.
    """
    df = spark.table(table)
    stored = {f.name: f.dataType.simpleString() for f in spark.read.parquet(*df.inputFiles()[:1]).schema.fields} if df.inputFiles() else {}
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = filled.unpivot([], df.columns, "col_name", "filled")
    described = describe_table(spark, table)
    types = F.create_map(*[F.lit(x) for kv in stored.items() for x in kv]) if stored else F.create_map()
    kind = F.coalesce(F.element_at(types.cast("map<string,string>"), F.col("col_name")), F.col("data_type"))
    return described.join(F.broadcast(rows), "col_name").select("position", "col_name", "data_type", kind.alias("stored_type"), "filled")


def audit(spark: SparkSession, table: str, history_table: str | None = None) -> dict[str, DataFrame]:
    """The standard post-load check suite as named DataFrames.

    ``history`` is included when a history table exists: ``history_table``,
    or by default the ``run_history`` table the writer keeps next to ``table``.
    """
    from staylake.sinks.table import history_table_for, table_history

    df = spark.table(table)
    checks = {
        "row_count": row_count(df),
        "schema": describe_table(spark, table),
        "sample": sample_rows(df, 5, order_by="transaction_id"),
        "by_region": breakdown_by(df, "region"),
        "by_status": breakdown_by(df, "status"),
    }
    hist = history_table or history_table_for(table)
    if spark.catalog.tableExists(hist):
        checks["history"] = table_history(spark, table, hist)
    return checks
