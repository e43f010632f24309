"""Incremental append: new JSON Lines files -> mapped bookings.

The append mode of the table writer is meant for incremental loads. In
Spark that is a file-source stream: each micro-batch picks up files not seen
before (tracked in the stream's checkpoint), and ``foreachBatch`` runs the
same parse -> reject split -> map -> append as a batch load.

A micro-batch that is re-run after a failure carries the same ``run_id``
(stream id + batch id), so that it is loaded once wherever the failure was
(see ``staylake.sinks.commit``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staylake.plans.load import load_parsed
from staylake.plans.mapping import Lookups
from staylake.session import shared_dir
from staylake.sinks.table import _aqe_on
from staylake.sources.json_lines import parse_json_lines


@contextmanager
def _adaptive(session: SparkSession, wanted: bool) -> Iterator[None]:
    """AQE in a stream's session for the jobs of a batch, if ``wanted``.

    A stream turns AQE off in the session of its own, for the number of its
    state's partitions is fixed. The plan of a batch is made by then; what is
    done with its rows is a batch load, and clusters them by partition value
    before the write as any other. Without that every task of the state writes
    a file for every partition value. The rule left out would drop the count of
    the records read from the plan of a batch without rows.
    """
    empty = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    excluded = session.conf.get("spark.sql.adaptive.optimizer.excludedRules", None)
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.optimizer.excludedRules": f"{excluded},{empty}" if excluded else empty}
    before = {k: session.conf.get(k, None) for k in settings} if wanted else {}
    for k in before:
        session.conf.set(k, settings[k])
    try:
        yield
    finally:
        for k, v in before.items():
            session.conf.unset(k) if v is None else session.conf.set(k, v)


def append_batch(batch: DataFrame, lookups: Lookups, table: str, run_id: str, reject_table: str | None = None) -> None:
    """Append one batch of parsed records, once however often it is run."""
    load_parsed(batch, lookups, table, "append", run_id, reject_table)


def first_deliveries(parsed: DataFrame, within: str) -> DataFrame:
    """A stream of parsed records without those whose reservation was delivered before, up to ``within`` ago.

    Keyed state of the stream: it holds the reservations of that time. Records
    without a reservation, broken ones too, are not told from each other and
    all stay.
    """
    key, at = "__reservation", "__delivered_at"
    keyed = parsed.withColumn(key, F.col("accommodations.reservation")).withColumn(at, F.current_timestamp())
    once = keyed.where(F.col(key).isNotNull()).withWatermark(at, within).dropDuplicatesWithinWatermark([key])
    return once.drop(key, at).unionByName(parsed.where(F.col("accommodations.reservation").isNull()))


def start_incremental_load(
    spark: SparkSession,
    source_dir: str,
    lookups: Lookups,
    table: str,
    *,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    trigger_interval: str = "1 minute",
    reject_table: str | None = None,
    duplicates_within: str | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops after the files present now,
    otherwise it keeps checking for new files every ``trigger_interval``.

    The checkpoint defaults to a folder named after the table below the
    shared checkpoint area, so a restart resumes where the last run stopped.
    With ``duplicates_within`` (``"7 days"``) a booking that is delivered
    again in that time, under another file name too, is not booked again.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    parsed = parse_json_lines(reader.load(source_dir))
    if duplicates_within:
        parsed = first_deliveries(parsed, duplicates_within)
    ckpt = checkpoint_location or f"{shared_dir(spark)}/staylake/streams/{table}"
    # The checkpoint is the stream's identity: same folder, same run ids after a restart.
    stream_key = uuid.uuid5(uuid.NAMESPACE_URL, ckpt).hex
    adaptive = _aqe_on(spark)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        with _adaptive(batch.sparkSession, adaptive):
            append_batch(batch, lookups, table, f"{stream_key}-{batch_id}", reject_table)

    writer = parsed.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    return writer.start()


def load_available(
    spark: SparkSession,
    source_dir: str,
    lookups: Lookups,
    table: str,
    **kw,
) -> StreamingQuery:
    """Load every file not loaded yet, wait for it, and return the finished query.

    Micro-batches write through the stream's own session; the table is
    refreshed here so the caller's session lists the new files too.
    """
    query = start_incremental_load(spark, source_dir, lookups, table, available_now=True, **kw)
    query.awaitTermination()
    spark.catalog.refreshTable(table)
    return query
