"""Headline benchmark: prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Setup (not timed) materialises the inputs once, the way a real load finds
them on storage: raw nested bookings as parquet and as JSON Lines (clean and
with corrupt records), each split into ``BENCH_CPUS`` files, and the mapped
bookings as the partitioned table. The driver tables themselves are single
row-group files, which Spark cannot split, so timing straight off them
would measure one task. Each query then runs once to warm up and
``BENCH_RUNS`` times timed; the median is reported. Results are forced with a
``noop`` write (every column computed, nothing collected) except the small
audit results, which are collected.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from staylake.operators.audit import breakdown_by, row_count  # noqa: E402
from staylake.operators.rates import usd_rates, wanted_currencies  # noqa: E402
from staylake.operators.rejects import split_rejects  # noqa: E402
from staylake.plans import queries as Q  # noqa: E402
from staylake.plans.load import run_load  # noqa: E402
from staylake.plans.mapping import map_bookings  # noqa: E402
from staylake.session import local_session, scratch_path  # noqa: E402
from staylake.sinks.table import scan_bookings, write_table  # noqa: E402
from staylake.sources import tpch_bookings as fx  # noqa: E402
from staylake.sources.json_arrays import rewrite_json_arrays  # noqa: E402
from staylake.sources.json_lines import read_json_lines  # noqa: E402


def _noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _plan(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _python_nodes(plan: str) -> int:
    return len(re.findall(r"(BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas)", plan))


def _source_scans(plan: str) -> int:
    return len(re.findall(r"FileScan (text|json)|Scan text", plan))


def _timed(fn, runs: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark: SparkSession = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="staylake-bench")

    # ---- setup (untimed)
    files = int(cpus) if cpus.isdigit() else 8
    lookups = Q.fixture_lookups(spark, sf_dir)
    raw_dir = scratch_path(spark, "bench_raw")
    fx.raw_bookings(spark, sf_dir).repartition(files).write.parquet(raw_dir)
    jsonl = scratch_path(spark, "bench_jsonl")
    fx.booking_json_lines(spark, sf_dir).repartition(files).write.text(jsonl)
    corrupt = scratch_path(spark, "bench_jsonl_corrupt")
    fx.booking_json_lines(spark, sf_dir, corrupt_every=Q.CORRUPT_EVERY).repartition(files).write.text(corrupt)
    arrays = Q._write_array_files(spark, sf_dir)
    raw = spark.read.parquet(raw_dir)
    db = Q._database(spark, "bench")
    table = f"{db}.bookings"
    write_table(map_bookings(raw, lookups), table, "overwrite")
    n_rows = raw.count()
    quotes = fx.quotes(spark)
    queries = {
        "map_bookings": lambda: _noop(map_bookings(raw, lookups)),
        "json_lines_roundtrip": lambda: _noop(map_bookings(split_rejects(read_json_lines(spark, jsonl))[0], lookups)),
        "write_overwrite": lambda: write_table(map_bookings(raw, lookups), table, "overwrite"),
        "load_with_rejects": lambda: run_load(spark, corrupt, lookups, f"{db}.loaded", "overwrite"),
        "breakdown_region": lambda: breakdown_by(spark.table(table), "region").collect(),
        "breakdown_status": lambda: breakdown_by(spark.table(table), "status").collect(),
        "row_count": lambda: row_count(spark.table(table)).collect(),
        "pruned_scan": lambda: _noop(scan_bookings(spark, table, Q.SCAN_FROM, Q.SCAN_TO, Q.SCAN_REGIONS)),
        "usd_rates": lambda: usd_rates(quotes, wanted_currencies(raw, "currencies.booker")).collect(),
        "json_array_rewrite": lambda: rewrite_json_arrays(spark, arrays, scratch_path(spark, "bench_rewrite")),
    }
    results = {name: round(_timed(fn, runs), 3) for name, fn in queries.items()}
    total = round(sum(results.values()), 3)

    flagship_plan = _plan(map_bookings(raw, lookups))
    roundtrip_plan = _plan(map_bookings(split_rejects(read_json_lines(spark, jsonl))[0], lookups))
    table_files = spark.table(table).inputFiles()
    all_parts = spark.sql(f"SHOW PARTITIONS {table}").count()
    scanned = scan_bookings(spark, table, Q.SCAN_FROM, Q.SCAN_TO, Q.SCAN_REGIONS).inputFiles()
    parts_read = len({f.rsplit("/", 1)[0] for f in scanned})
    facts = {
        "map_bookings_python_nodes": _python_nodes(flagship_plan),
        "map_bookings_broadcast_joins": flagship_plan.count("BroadcastHashJoin"),
        "json_lines_roundtrip_source_scans": _source_scans(roundtrip_plan),
        "write_overwrite_files": len(table_files),
        "pruned_scan_partitions_read": parts_read,
        "table_partitions_total": all_parts,
    }
    out = {
        "metric": "total_median_sec",
        "value": total,
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "rows": n_rows,
        "map_bookings_rows_per_sec": round(n_rows / results["map_bookings"]) if results["map_bookings"] else None,
        **facts,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
