"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query builds its raw booking input from the driver tables in
``sf_dir`` (``staylake.sources.tpch_bookings``) and runs the library on all
of it. Queries that exercise files or tables write them below the session's
shared scratch folder (``spark.checkpoint.dir``), in a fresh folder per call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylake.errors import UnsupportedWriteMode
from staylake.functions.fields import country_code, date_only, prefixed_id, safe_path
from staylake.functions.labels import attribution, device_name, label_part
from staylake.operators.audit import audit, breakdown_by, column_profile, describe_table, row_count, sample_rows
from staylake.operators.drift import drift_profile
from staylake.operators.lookups import check_lookup, lookup_or_default, lookup_or_keep
from staylake.operators.rates import all_usd_rates, convert_amount, missing_rates, usd_rates, wanted_currencies
from staylake.operators.rejects import recovered_id, reject_reason, split_rejects
from staylake.operators.summaries import audit_counts
from staylake.plans.load import run_load
from staylake.plans.mapping import Lookups, load_lookups, map_bookings, transform_sample
from staylake.schemas import SUMMARY_KEYS
from staylake.session import application_id, scratch_path
from staylake.sinks.table import ensure_database, scan_bookings, scan_wanted, table_history, write_table
from staylake.sources import tpch_bookings as fx
from staylake.sources.json_arrays import read_json_array, rewrite_json_arrays
from staylake.sources.json_lines import read_json_lines
from staylake.sources.mappings import load_mapping, write_mapping

# Fixture rule: the JSON text of every 37th booking (by id) is cut short.
CORRUPT_EVERY = 37
# Records per JSON array file in the array-layout fixtures.
ARRAY_CHUNK = 1000
# Pruned-scan parameters.
SCAN_FROM, SCAN_TO, SCAN_REGIONS = "1995-03-15", "1996-08-31", ["ASIA", "EUROPE", "other"]


def fixture_lookups(spark: SparkSession, sf_dir: str, status_null_value: bool = False) -> Lookups:
    return Lookups.of(
        fx.status_mapping(spark, with_null_value=status_null_value),
        fx.region_mapping(spark, sf_dir),
        all_usd_rates(fx.quotes(spark)),
    )


# ---------------------------------------------------------------- mapping


def map_bookings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: every raw booking mapped to the flat booking schema."""
    return map_bookings(fx.raw_bookings(spark, sf_dir), fixture_lookups(spark, sf_dir))


def label_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_bookings(spark, sf_dir)
    parts = attribution(F.col("label"))
    return raw.select(
        F.col("id"),
        F.col("label"),
        parts["site_key"].alias("site_key"),
        parts["device"].alias("device"),
        parts["referral_property_id"].alias("referral_property_id"),
    )


def device_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_bookings(spark, sf_dir)
    device = device_name(label_part(F.col("label"), "d")).alias("device")
    return raw.select(device).groupBy("device").agg(F.count(F.lit(1)).alias("bookings"))


def safe_nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_bookings(spark, sf_dir)
    return raw.select(
        F.col("id"),
        safe_path(raw, "accommodations.reservation").alias("transaction_id"),
        safe_path(raw, "booker.travel_purpose").alias("travel_purpose"),
        safe_path(raw, "booker.address.country").alias("country"),
        safe_path(raw, "currencies.booker").alias("currency"),
        safe_path(raw, "booker.address.city").alias("missing_leaf"),
        safe_path(raw, "label.inner").alias("through_scalar"),
    )


def property_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_bookings(spark, sf_dir)
    return raw.select("id", prefixed_id(safe_path(raw, "accommodation_details.accommodation")).alias("property_id"))


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_bookings(spark, sf_dir)
    return raw.select("id", country_code(safe_path(raw, "booker.address.country")).alias("country_code"))


def stay_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_bookings(spark, sf_dir)
    return raw.select(
        "id", date_only(F.col("start")).alias("check_in_date"), date_only(F.col("end")).alias("check_out_date")
    )


def _mapped_with_id(spark: SparkSession, sf_dir: str, lookups: Lookups) -> DataFrame:
    return map_bookings(fx.raw_bookings(spark, sf_dir), lookups, keep=("id",))


def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped_with_id(spark, sf_dir, fixture_lookups(spark, sf_dir)).select("id", "status")


def status_lookup_null_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = fixture_lookups(spark, sf_dir, status_null_value=True)
    return _mapped_with_id(spark, sf_dir, lk).select("id", "status")


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped_with_id(spark, sf_dir, fixture_lookups(spark, sf_dir)).select("id", "country_code", "region")


def transform_sample_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_sample(fx.raw_bookings(spark, sf_dir), fixture_lookups(spark, sf_dir), n=100, key="id")


# ---------------------------------------------------------------- rates


def _booking_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_bookings(spark, sf_dir)
    return wanted_currencies(raw, safe_path(raw, "currencies.booker"))


def currencies_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _booking_currencies(spark, sf_dir).orderBy("currency")


def usd_rates_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usd_rates(fx.quotes(spark), _booking_currencies(spark, sf_dir))


def usd_rates_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates for the bookings without a currency: nothing is wanted, so there are none, not even USD."""
    raw = fx.raw_bookings(spark, sf_dir)
    code = safe_path(raw, "currencies.booker")
    return usd_rates(fx.quotes(spark), wanted_currencies(raw.where(code.isNull()), code))


def usd_rates_zero_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates where the currency quoted at zero is wanted (it gets none) and no booking is in dollars (which get theirs)."""
    raw = fx.raw_bookings(spark, sf_dir)
    code = safe_path(raw, "currencies.booker")
    code = F.when(F.lower(code) == "usd", F.lit("chf")).otherwise(code)
    return usd_rates(fx.quotes(spark), wanted_currencies(raw, code))


def map_bookings_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping with a revenue of its own, and its value in dollars."""
    raw = fx.raw_bookings(spark, sf_dir)
    revenue = F.col("id").cast("long") % 1000 * 1.25
    return map_bookings(raw, fixture_lookups(spark, sf_dir), revenue=revenue).select("transaction_id", "revenue", "revenue_usd")


def missing_rates_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_rates(_booking_currencies(spark, sf_dir), all_usd_rates(fx.quotes(spark)))


def convert_amount_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = fx.bookings_flat(spark, sf_dir)
    out = convert_amount(flat, F.col("amount"), F.col("currency"), all_usd_rates(fx.quotes(spark)), "amount_usd")
    return out.select("id", "amount_usd")


# ---------------------------------------------------------------- sources


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rejects_src")
    fx.booking_json_lines(spark, sf_dir, corrupt_every=CORRUPT_EVERY).write.text(path)
    _, bad = split_rejects(read_json_lines(spark, path))
    return bad.select("id", "reason")


def json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    fx.booking_json_lines(spark, sf_dir).write.text(path)
    good, _ = split_rejects(read_json_lines(spark, path))
    return map_bookings(good, fixture_lookups(spark, sf_dir))


def _write_array_files(spark: SparkSession, sf_dir: str) -> str:
    """Fixture: raw bookings as JSON array files of about ``ARRAY_CHUNK`` records each.

    Records are dealt round-robin into ``rows / ARRAY_CHUNK`` buckets, so an
    array's size does not depend on the ids. Each file holds one array with
    one record per line, valid for both the ``whole`` and ``lines`` layout.
    """
    path = scratch_path(spark, "json_array")
    docs = fx.booking_json_lines(spark, sf_dir)
    buckets = max(1, -(-docs.count() // ARRAY_CHUNK))
    dealt = docs.repartition(buckets).select(F.spark_partition_id().alias("chunk"), "value")
    chunks = dealt.groupBy("chunk").agg(F.collect_list("value").alias("records"))
    body = F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]"))
    chunks.select("chunk", body.alias("value")).write.partitionBy("chunk").text(path)
    return path


def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_array_files(spark, sf_dir)
    good, _ = split_rejects(read_json_array(spark, path, layout="whole"))
    return map_bookings(good, fixture_lookups(spark, sf_dir))


def json_array_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_array_files(spark, sf_dir)
    good, _ = split_rejects(read_json_array(spark, path, layout="lines"))
    return map_bookings(good, fixture_lookups(spark, sf_dir))


def json_array_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _write_array_files(spark, sf_dir)
    dst = scratch_path(spark, "json_array_rewritten")
    rewrite_json_arrays(spark, src, dst, layout="whole")
    good, _ = split_rejects(read_json_lines(spark, dst))
    return map_bookings(good, fixture_lookups(spark, sf_dir))


def json_line_hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with text after the record, arrays that close twice, several records: what becomes of each booking."""
    docs, k, v = fx.booking_json_docs(spark, sf_dir), F.col("id") % 11, F.col("value")
    line = (
        F.when(k == 0, F.concat(v, F.lit("],["), v))
        .when(k == 1, F.concat(v, F.lit("garbage")))
        .when(k == 2, F.concat(F.lit("["), v, F.lit(" , "), v, F.lit("]")))
        .when(k == 3, F.concat(F.lit("["), v, F.lit("]] "), v))
        .when(k == 4, F.concat(v, F.lit(","), v))
        .otherwise(v)
    )
    path = scratch_path(spark, "hazards")
    docs.select(line.alias("value")).write.text(path)
    return _outcomes(read_json_lines(spark, path))


def _outcomes(parsed: DataFrame) -> DataFrame:
    """Records by id and what becomes of them: ``booked``, or why not."""
    outcome = F.coalesce(reject_reason(parsed), F.lit("booked"))
    rows = parsed.select(recovered_id(parsed).alias("id"), outcome.alias("outcome"))
    return rows.groupBy("id", "outcome").agg(F.count(F.lit(1)).alias("records"))


def json_array_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files on one line: strings and records that are not closed, and arrays of objects inside records."""
    k = F.col("o_orderkey")
    start = F.concat(F.lit('{"id":'), k)
    record = (
        F.when(k % 13 == 0, F.concat(start, F.lit(',"label":"abc}')))
        .when(k % 13 == 1, F.concat(start, F.lit(',"label":')))
        .when(k % 13 == 2, F.concat(start, F.lit(',"rooms":[{"id":1},{"id":"},{"}],"status":"F"}')))
        .otherwise(F.concat(start, F.lit(',"status":"F"}')))
    )
    docs = fx.table(spark, sf_dir, "orders").select(record.alias("value"))
    buckets = max(1, -(-docs.count() // ARRAY_CHUNK))
    chunks = docs.repartition(buckets).groupBy(F.spark_partition_id().alias("chunk")).agg(F.collect_list("value").alias("records"))
    path = scratch_path(spark, "json_array_broken")
    chunks.select("chunk", F.concat(F.lit("["), F.array_join("records", ","), F.lit("]")).alias("value")).write.partitionBy("chunk").text(path)
    return _outcomes(read_json_array(spark, path, layout="whole"))


def number_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of every notation and length, as the rewrite of array files writes them."""
    key, cents = (F.col("o_orderkey") + 1).cast("string"), F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    parts = ['[{"id":', key, ', "a":', cents, 'e-2,"b": ', key, 'e3,"c":', key, '.50e1,"d":"', key, '.50 ","e":', key, "7" * 40 + '.000,"f":-0.0}]']
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    src, dst = scratch_path(spark, "numbers"), scratch_path(spark, "numbers_rewritten")
    fx.table(spark, sf_dir, "orders").select(text.alias("value")).write.text(src)
    rewrite_json_arrays(spark, src, dst, layout="lines")
    return spark.read.text(dst)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown and retyped fields planted in the bookings' records."""
    k = F.col("o_orderkey")
    parts = [
        F.concat(F.lit('{"id":'), k),
        F.when(k % 7 == 0, F.lit(',"channel":"web"')).otherwise(F.lit("")),
        F.when(k % 11 == 0, F.lit(',"label":{"k":"a"}')).otherwise(F.lit(',"label":"k-a"')),
        F.when(k % 13 == 0, F.lit(',"booker":5')).when(k % 13 == 1, F.lit(',"booker":{"address":{"city":"x"}}')).otherwise(F.lit("")),
        F.lit("}"),
    ]
    return drift_profile(fx.table(spark, sf_dir, "orders").select(F.concat(*parts).alias("value")))


def large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup beyond the broadcast bound, nine tenths of the rows with one key; unknown keys kept, or a default."""
    k = F.col("o_orderkey")
    code = F.when(k % 10 != 0, F.lit("1")).when(k % 3 == 0, F.concat(F.lit("x"), F.col("o_custkey"))).when(k % 7 != 0, F.col("o_custkey").cast("string"))
    rows = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), code.alias("code"))
    pairs = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("value"))
    large = check_lookup(pairs, max_broadcast_rows=10)
    return lookup_or_default(lookup_or_keep(rows, F.col("code"), large, "kept"), F.col("code"), large, "segment", "none")


def mapping_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mappings")
    write_mapping(fx.region_mapping(spark, sf_dir), f"{path}/country_region.json")
    return load_mapping(spark, f"{path}/country_region.json")


def lookups_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default wiring: both mapping files written to a folder, loaded back, then the full mapping."""
    folder = scratch_path(spark, "mappings_dir")
    write_mapping(fx.status_mapping(spark), f"{folder}/status_mapping.json")
    write_mapping(fx.region_mapping(spark, sf_dir), f"{folder}/country_region.json")
    lk = load_lookups(spark, folder, fx.quotes(spark))
    return map_bookings(fx.raw_bookings(spark, sf_dir), lk)


def events_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    parsed = ev.select("event_id", F.from_json("props", StructType().add("k", "string")).alias("props"))
    return parsed.select("event_id", safe_path(parsed, "props.k").alias("k"))


# ---------------------------------------------------------------- tables

_TABLES: dict[tuple[str, str], str] = {}


def _database(spark: SparkSession, tag: str) -> str:
    loc = scratch_path(spark, "warehouse")
    db = f"staylake_{tag}_{loc.rsplit('/', 1)[-1][:12]}"
    ensure_database(spark, db, loc)
    return db


def bookings_table(spark: SparkSession, sf_dir: str) -> str:
    """Mapped bookings written once per session and input folder; returns its name."""
    key = (application_id(spark), sf_dir)
    name = _TABLES.get(key)
    if name is None or not spark.catalog.tableExists(name):
        name = f"{_database(spark, 'audit')}.bookings"
        write_table(map_bookings_q(spark, sf_dir), name, "overwrite")
        _TABLES[key] = name
    return name


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{_database(spark, 'ow')}.bookings"
    mapped = map_bookings_q(spark, sf_dir)
    write_table(mapped, table, "overwrite")
    write_table(mapped, table, "overwrite")  # a rerun replaces, never duplicates
    return spark.table(table)


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{_database(spark, 'ap')}.bookings"
    mapped = map_bookings_q(spark, sf_dir)
    write_table(mapped, table, "overwrite")
    write_table(mapped, table, "append")
    return spark.table(table)


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{_database(spark, 'hist')}.bookings"
    src = scratch_path(spark, "history_src")
    fx.booking_json_lines(spark, sf_dir, corrupt_every=CORRUPT_EVERY).write.text(src)
    lk = fixture_lookups(spark, sf_dir)
    run_load(spark, src, lk, table, "overwrite")
    run_load(spark, src, lk, table, "append")
    return table_history(spark, table).select("mode", "rows_written", "rows_rejected")


def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{_database(spark, 'load')}.bookings"
    src = scratch_path(spark, "load_src")
    fx.booking_json_lines(spark, sf_dir, corrupt_every=CORRUPT_EVERY).write.text(src)
    run_load(spark, src, fixture_lookups(spark, sf_dir), table, "overwrite")
    return spark.table(table)


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the raw bookings in as several files, one micro-batch each, appended once."""
    from staylake.streaming.incremental import load_available

    table = f"{_database(spark, 'inc')}.bookings"
    src = scratch_path(spark, "incremental_src")
    fx.booking_json_lines(spark, sf_dir).repartition(3).write.text(src)
    ckpt = scratch_path(spark, "stream_ckpt")
    load_available(spark, src, fixture_lookups(spark, sf_dir), table, checkpoint_location=ckpt, max_files_per_trigger=1)
    return spark.table(table)


def load_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run loaded twice, under its id: its rows are there once."""
    table = f"{_database(spark, 'again')}.bookings"
    src = scratch_path(spark, "retry_src")
    fx.booking_json_lines(spark, sf_dir, corrupt_every=CORRUPT_EVERY).write.text(src)
    for _ in range(2):
        run_load(spark, src, fixture_lookups(spark, sf_dir), table, "append", run_id="2026-12-01")
    return spark.table(table)


def stream_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file delivered twice, under two names: each booking is booked once."""
    from staylake.streaming.incremental import load_available

    table = f"{_database(spark, 'twice')}.bookings"
    src = scratch_path(spark, "twice_src")
    lines = fx.booking_json_lines(spark, sf_dir)
    lines.write.text(f"{src}/a")
    lines.write.text(f"{src}/b")
    ckpt = scratch_path(spark, "stream_ckpt")
    load_available(
        spark, f"{src}/*", fixture_lookups(spark, sf_dir), table, checkpoint_location=ckpt, max_files_per_trigger=1, duplicates_within="7 days"
    )
    return spark.table(table)


def audit_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and breakdowns after overwrite, append, append, from the counts that the runs left."""
    table = f"{_database(spark, 'counts')}.bookings"
    src = scratch_path(spark, "counts_src")
    fx.booking_json_lines(spark, sf_dir, corrupt_every=CORRUPT_EVERY).write.text(src)
    for mode in ("append", "overwrite", "append", "append"):
        run_load(spark, src, fixture_lookups(spark, sf_dir), table, mode)
    checks = audit_counts(spark, table)
    out = checks["row_count"].select(F.lit("row_count").alias("check"), F.lit(None).cast("string").alias("key"), F.col("cnt").alias("n"))
    for c in SUMMARY_KEYS:
        out = out.unionByName(checks[f"by_{c}"].select(F.lit(f"by_{c}").alias("check"), F.col(c).alias("key"), F.col("bookings").alias("n")))
    return out


def refused_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any other write mode is refused, and leaves the table as it was."""
    table = bookings_table(spark, sf_dir)
    refused = []
    for mode in ("merge", "", "APPEND"):
        try:
            write_table(map_bookings_q(spark, sf_dir), table, mode)
        except UnsupportedWriteMode:
            refused.append(mode)
    rows = row_count(spark.table(table))
    return rows.select(F.explode(F.array(*[F.lit(m) for m in refused])).alias("mode"), F.col("cnt"))


def sanity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog takes a database, a table, rows and a read."""
    table = f"{_database(spark, 'sanity')}.regions"
    fx.table(spark, sf_dir, "region").createOrReplaceTempView("sanity_regions")
    spark.sql(f"CREATE TABLE {table} (r_regionkey BIGINT, r_name STRING) USING parquet")
    spark.sql(f"INSERT INTO {table} SELECT r_regionkey, r_name FROM sanity_regions")
    return spark.table(table)


def wanted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings of the months of the orders' first year and the regions of even key, by dynamic partition pruning."""
    first = fx.table(spark, sf_dir, "orders").agg(F.trunc(F.min(F.col("o_orderdate").cast("date")), "YEAR").alias("first"))
    regions = fx.table(spark, sf_dir, "region").where("r_regionkey % 2 = 0")
    wanted = regions.select(F.col("r_name").alias("region"), first.scalar().alias("first"))
    wanted = wanted.select("region", F.explode(F.expr("sequence(first, add_months(first, 11), INTERVAL 1 MONTH)")).alias("check_in_month"))
    return scan_wanted(spark, bookings_table(spark, sf_dir), wanted)


def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_bookings(spark, bookings_table(spark, sf_dir), SCAN_FROM, SCAN_TO, SCAN_REGIONS)


def row_count_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(spark.table(bookings_table(spark, sf_dir)))


def _breakdown(column: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return breakdown_by(spark.table(bookings_table(spark, sf_dir)), column)

    q.__name__ = f"breakdown_{column}"
    return q


def sample_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the dry run."""
    return row_count(transform_sample_q(spark, sf_dir))


def audit_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of the audit in one table: ``(check, key, n)``."""
    checks = audit(spark, bookings_table(spark, sf_dir))
    parts = {
        "row_count": (F.lit(None), "cnt"),
        "schema": (F.col("col_name"), "position"),
        "sample": (F.col("transaction_id"), F.lit(1)),
        "by_region": (F.col("region"), "bookings"),
        "by_status": (F.col("status"), "bookings"),
        "history": (F.col("mode"), "rows_written"),
    }
    out = None
    for name, (key, n) in parts.items():
        n = F.col(n) if isinstance(n, str) else n
        rows = checks[name].select(F.lit(name).alias("check"), key.cast("string").alias("key"), n.cast("long").alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


def sample_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(spark.table(bookings_table(spark, sf_dir)), 5, order_by="transaction_id")


def describe_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_table(spark, bookings_table(spark, sf_dir))


def column_profile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(spark, bookings_table(spark, sf_dir))


def orders_breakdown_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breakdown_by(fx.table(spark, sf_dir, "orders"), "o_orderpriority")


def events_breakdown_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breakdown_by(fx.table(spark, sf_dir, "events"), "event_type")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "map_bookings": map_bookings_q,
    "label_parse": label_parse,
    "device_codes": device_codes,
    "safe_nested_fields": safe_nested_fields,
    "property_ids": property_ids,
    "country_codes": country_codes,
    "stay_dates": stay_dates,
    "status_lookup": status_lookup,
    "status_lookup_null_value": status_lookup_null_value,
    "region_lookup": region_lookup,
    "transform_sample": transform_sample_q,
    "currencies_distinct": currencies_distinct,
    "usd_rates": usd_rates_q,
    "usd_rates_empty": usd_rates_empty,
    "usd_rates_zero_quote": usd_rates_zero_quote,
    "map_bookings_revenue": map_bookings_revenue,
    "missing_rates": missing_rates_q,
    "convert_amount": convert_amount_q,
    "rejects": rejects,
    "json_lines_roundtrip": json_lines_roundtrip,
    "json_array_scan": json_array_scan,
    "json_array_lines_scan": json_array_lines_scan,
    "json_array_rewrite": json_array_rewrite,
    "json_line_hazards": json_line_hazards,
    "json_array_broken": json_array_broken,
    "number_rewrite": number_rewrite,
    "schema_drift": schema_drift,
    "large_lookup": large_lookup,
    "mapping_load": mapping_load,
    "lookups_from_files": lookups_from_files,
    "events_props": events_props,
    "write_overwrite": write_overwrite,
    "write_append": write_append,
    "run_history": run_history,
    "load_table": load_table,
    "incremental_append": incremental_append,
    "load_retried": load_retried,
    "stream_duplicates": stream_duplicates,
    "audit_incremental": audit_incremental,
    "refused_mode": refused_mode,
    "sanity_table": sanity_table,
    "wanted_scan": wanted_scan,
    "pruned_scan": pruned_scan,
    "row_count": row_count_q,
    "breakdown_region": _breakdown("region"),
    "breakdown_status": _breakdown("status"),
    "breakdown_device": _breakdown("device"),
    "breakdown_country": _breakdown("country_code"),
    "sample_rows": sample_rows_q,
    "sample_count": sample_count,
    "describe_table": describe_table_q,
    "column_profile": column_profile_q,
    "audit_suite": audit_suite,
    "orders_breakdown_priority": orders_breakdown_priority,
    "events_breakdown_type": events_breakdown_type,
}

