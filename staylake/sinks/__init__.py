"""Sinks: the partitioned bookings table, rejects and run history."""

from staylake.sinks.table import (
    WRITE_MODES,
    WriteResult,
    ensure_database,
    ensure_table,
    history_table_for,
    record_run,
    rejects_table_for,
    scan_bookings,
    table_history,
    write_rejects,
    write_table,
)

__all__ = [
    "WRITE_MODES",
    "WriteResult",
    "ensure_database",
    "ensure_table",
    "history_table_for",
    "record_run",
    "rejects_table_for",
    "scan_bookings",
    "table_history",
    "write_rejects",
    "write_table",
]
