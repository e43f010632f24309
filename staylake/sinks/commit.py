"""A load commits once: staged under its run id, then moved into its tables.

One job writes the good and the rejected rows of a run into a staging folder of
its own below the table (names with ``_`` in front are no table data), in the
table's partition layout, the flag in front. A small file of counts, written
next, says that the staging is whole. Only then are files moved into the
bookings and the rejects table, the run's counts into the table's summaries,
and last the run is recorded in the history.

Whatever fails on the way, the same run id started again ends in the same
state: without the counts the staging is written anew, with them the rest of
the files is moved, and a recorded run is done. An overwrite first deletes the
table's files and marks that this is done; only then its own files move.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from staylake.errors import LoadMismatch
from staylake.schemas import BOOKINGS_TABLE, PARTITION_COLUMNS, REJECT_TABLE, SUMMARY, SUMMARY_KEYS
from staylake.sinks.table import _aqe_on, _quoted, clustered, ensure_side_table, ensure_table, summaries_table_for

KIND = "load_kind"
GOOD, BAD = "good", "bad"


@dataclass(frozen=True)
class Staged:
    """What a whole staging folder holds."""

    rows_read: int
    rows_written: int
    rows_rejected: int


class _Files:
    """The few file operations of a commit, on whatever file system the path is."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)

    def children(self, p: str) -> list[tuple[str, bool]]:
        """Names of what is in a folder and whether each is a folder; marks are left out."""
        if not self.exists(p):
            return []
        found = [(f.getPath().getName(), f.isDirectory()) for f in self.fs.listStatus(self.path(p))]
        return [f for f in found if not f[0].startswith(("_", "."))]

    def move(self, src: str, dst: str) -> None:
        if not self.fs.rename(self.path(src), self.path(dst)):
            raise OSError(f"cannot move {src} to {dst}")

    def move_into(self, src: str, dst: str) -> None:
        """Move what is in the folder ``src`` to the same places below the folder ``dst``; a folder that ``dst`` lacks moves whole."""
        found = self.children(src)
        # Files are moved unseen: a partition's folder is not listed for the files of the runs before.
        there = {name for name, _ in self.children(dst)} if any(folder for _, folder in found) else set()
        for name, folder in found:
            if folder and name in there:
                self.move_into(f"{src}/{name}", f"{dst}/{name}")
            else:
                self.move(f"{src}/{name}", f"{dst}/{name}")


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def staging_path(spark: SparkSession, table: str, run_id: str) -> str:
    return f"{table_location(spark, table)}/_staging/{uuid.uuid5(uuid.NAMESPACE_URL, run_id).hex}"


def _staged(spark: SparkSession, path: str) -> Staged | None:
    """The counts of a whole staging folder, None if it is not whole."""
    if not _Files(spark, path).exists(f"{path}/counts/_SUCCESS"):
        return None
    return Staged(**json.loads(spark.read.text(f"{path}/counts").first()[0]))


def stage(rows: DataFrame, path: str, read: Observation, recount) -> Staged:
    """Write tagged rows (``KIND``, the bookings table's and the rejects table's columns) under ``path``.

    ``read`` has counted the records in the scan (``rows``), apart from what
    is written. A stage that was run again may have counted twice there: if
    the two disagree, ``recount()`` counts the records by themselves, and if
    they still do, ``LoadMismatch`` is raised before any table has changed.
    """
    spark = rows.sparkSession
    if _aqe_on(spark):
        rows = clustered(rows, KIND)
    obs = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    kinds = {k: F.count_if(F.col(KIND) == k).alias(k) for k in (GOOD, BAD)}
    rows.observe(obs, *kinds.values()).write.mode("overwrite").partitionBy(KIND, *PARTITION_COLUMNS).parquet(f"{path}/data")
    good, bad, seen = int(obs.get[GOOD]), int(obs.get[BAD]), int(read.get["rows"])
    if seen != good + bad:
        seen = recount()
        if seen != good + bad:
            raise LoadMismatch(f"{seen} records read, {good} booked and {bad} rejected; nothing was loaded")
    if good:
        booked = spark.read.schema(BOOKINGS_TABLE).option("basePath", f"{path}/data/{KIND}={GOOD}").parquet(f"{path}/data/{KIND}={GOOD}")
        counts = booked.groupBy(*SUMMARY_KEYS).agg(F.count(F.lit(1)).alias("bookings"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/summary")
    done = Staged(seen, good, bad)
    spark.createDataFrame([(json.dumps(asdict(done)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/counts")
    return done


def commit(spark: SparkSession, path: str, staged: Staged, table: str, mode: str, reject_table: str) -> None:
    """Move a whole staging folder into its tables; may be started again until it ends."""
    location = table_location(spark, table)
    files = _Files(spark, location)
    if mode == "overwrite" and not files.exists(f"{path}/cleared"):
        for name, _ in files.children(location):
            files.delete(f"{location}/{name}")
        files.fs.mkdirs(files.path(f"{path}/cleared"))
    files.move_into(f"{path}/data/{KIND}={GOOD}", location)
    # New partitions become known, and after an overwrite those without files are dropped.
    spark.sql(f"MSCK REPAIR TABLE {_quoted(table)} {'SYNC' if mode == 'overwrite' else 'ADD'} PARTITIONS")
    spark.catalog.refreshTable(_quoted(table))
    if staged.rows_rejected:
        ensure_side_table(spark, reject_table, REJECT_TABLE)
        target = table_location(spark, reject_table)
        none = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in PARTITION_COLUMNS)
        files.move_into(f"{path}/data/{KIND}={BAD}/{none}", target)
        spark.catalog.refreshTable(_quoted(reject_table))


def _folder_name(value: str) -> str:
    """A partition value as part of a folder name."""
    return re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


def commit_summary(spark: SparkSession, path: str, table: str, mode: str, run_id: str) -> None:
    """Move a run's counts into the table's summaries, one partition a run; an overwrite drops the others."""
    summaries = summaries_table_for(table)
    ensure_side_table(spark, summaries, SUMMARY, "run_id")
    location = table_location(spark, summaries)
    files = _Files(spark, location)
    place = f"run_id={_folder_name(run_id)}"
    if mode == "overwrite":
        for name, _ in files.children(location):
            if name != place:
                files.delete(f"{location}/{name}")
    if files.exists(f"{path}/summary") and not files.exists(f"{location}/{place}"):
        files.move(f"{path}/summary", f"{location}/{place}")
    spark.sql(f"MSCK REPAIR TABLE {_quoted(summaries)} SYNC PARTITIONS")
    spark.catalog.refreshTable(_quoted(summaries))


def load_once(
    spark: SparkSession, rows, table: str, mode: str, run_id: str, reject_table: str, read: Observation, recount, location: str | None = None
) -> Staged:
    """Stage ``rows()`` unless this run has been staged before, and commit. The caller records the run, then calls ``forget``."""
    ensure_table(spark, table, location)
    path = staging_path(spark, table, run_id)
    staged = _staged(spark, path) or stage(rows(), path, read, recount)
    commit(spark, path, staged, table, mode, reject_table)
    commit_summary(spark, path, table, mode, run_id)
    return staged


def forget(spark: SparkSession, table: str, run_id: str) -> None:
    """Delete the staging folder of a recorded run."""
    path = staging_path(spark, table, run_id)
    _Files(spark, path).delete(path)
