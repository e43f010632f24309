"""Stand-in booking input built from the driver's TPC-H-like tables.

The raw booking data itself is not available, so tests, the bench and the
registered queries derive raw records from ``orders``, ``customer`` and
``nation``. This module only shapes rows into the raw record schema (and its
JSON text); it does none of the mapping work. The variety rules (every n-th
order gets a null label, an empty country, ...) exist to put every edge case
the mapper handles into the input; the mapper never looks at them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.operators.lookups import check_lookup
from staylake.schemas import QUOTES, RAW_BOOKING
from staylake.sources.mappings import mapping_from_dict

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Fixed values (test fixture): raw status codes and their names; "P" is left
# unmapped so it passes through.
STATUS_NAMES = {
    "F": "confirmed",
    "O": "pending",
}

# Fixed values (test fixture): quotes as a rate service gives them, units of
# currency per USD. CHF has a zero quote (skipped); ZZZ has none at all.
QUOTES_PER_USD = {
    "EUR": 0.92,
    "GBP": 0.79,
    "JPY": 150.0,
    "CHF": 0.0,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bookings_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat raw booking per order (see FIXTURES.md section 4)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = check_lookup(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), key="n_nationkey")
    nation = F.broadcast(n.frame) if n.broadcast else n.frame
    j = o.join(c, o.o_custkey == c.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("o_orderkey")
    device_code = F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'm' WHEN 1 THEN 'd' WHEN 2 THEN 't' ELSE 'tv' END")
    label = (
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit("organic"))
        .otherwise(
            F.concat(
                F.when(k % 19 == 0, F.lit("k-first_")).otherwise(F.lit("")),
                F.lit("k-"),
                F.lower("c_mktsegment"),
                F.lit("_d-"),
                device_code,
                F.lit("_u-"),
                F.col("c_custkey").cast("string"),
                F.lit("_p-BC-"),
                (k % 500).cast("string"),
            )
        )
    )
    start = F.when(k % 29 == 0, F.lit(None).cast("string")).otherwise(F.date_format("o_orderdate", ISO_SECONDS))
    end = F.date_format(F.date_add(F.col("o_orderdate").cast("date"), (1 + k % 14).cast("int")), ISO_SECONDS)
    purpose = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'business' WHEN 1 THEN 'leisure' END")
    country = F.when(k % 23 == 0, F.lit("")).otherwise(F.lower("n_name"))
    currency = F.expr("CASE n_nationkey % 6 WHEN 0 THEN 'EUR' WHEN 1 THEN 'usd' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' WHEN 4 THEN 'ZZZ' END")
    accommodation = F.when(k % 31 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey"))
    return j.select(
        k.alias("id"),
        label.alias("label"),
        F.col("o_orderstatus").alias("status"),
        start.alias("start_ts"),
        end.alias("end_ts"),
        purpose.alias("travel_purpose"),
        country.alias("country"),
        currency.alias("currency"),
        k.alias("reservation"),
        accommodation.alias("accommodation"),
        F.col("o_totalprice").alias("amount"),
    )


def _nest(flat: DataFrame) -> DataFrame:
    """Flat rows -> nested raw record columns (ids still numeric)."""
    return flat.select(
        "id",
        "label",
        "status",
        F.col("start_ts").alias("start"),
        F.col("end_ts").alias("end"),
        F.struct("reservation").alias("accommodations"),
        F.struct("accommodation").alias("accommodation_details"),
        F.struct("travel_purpose", F.struct("country").alias("address")).alias("booker"),
        F.struct(F.col("currency").alias("booker")).alias("currencies"),
    )


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw booking records in exactly the ``RAW_BOOKING`` schema."""
    return _nest(bookings_flat(spark, sf_dir)).to(RAW_BOOKING)


def booking_json_docs(spark: SparkSession, sf_dir: str, corrupt_every: int | None = None) -> DataFrame:
    """Raw bookings as JSON text: ``(id, value)``, null fields left out.

    With ``corrupt_every=n`` the text of every record whose id is a multiple
    of ``n`` loses its last two characters, which makes it invalid JSON.
    """
    nested = _nest(bookings_flat(spark, sf_dir))
    doc = nested.select("id", F.to_json(F.struct(*[F.col(c) for c in nested.columns])).alias("value"))
    if corrupt_every:
        cut = F.expr("substring(value, 1, length(value) - 2)")
        doc = doc.withColumn("value", F.when(F.col("id") % corrupt_every == 0, cut).otherwise(F.col("value")))
    return doc


def booking_json_lines(spark: SparkSession, sf_dir: str, corrupt_every: int | None = None) -> DataFrame:
    """Raw bookings as JSON Lines text: ``(value)``."""
    return booking_json_docs(spark, sf_dir, corrupt_every).select("value")


def status_mapping(spark: SparkSession, with_null_value: bool = False) -> DataFrame:
    """Status lookup; the second version also maps ``P`` to null."""
    names = dict(STATUS_NAMES)
    if with_null_value:
        names["P"] = None
    return mapping_from_dict(spark, names)


def region_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country code -> region name from ``nation`` and ``region``."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (
        n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.upper("n_name").alias("key"), F.col("r_name").alias("value"))
    )


def quotes(spark: SparkSession) -> DataFrame:
    """Fixture quotes table ``(currency, usd_to_ccy)``."""
    return spark.createDataFrame(list(QUOTES_PER_USD.items()), QUOTES)
