"""Raw booking records -> flat mapped bookings.

The whole record mapping is one projection plus three left joins against
small, checked lookup tables (status names, country regions, USD rates).
There is no per-row Python: every field is a native expression, so the plan
is scan -> project -> broadcast joins -> project, inside whole-stage codegen,
and only the nested fields the mapping reads are parsed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.functions.fields import country_code, date_only, prefixed_id, safe_path
from staylake.functions.labels import attribution
from staylake.functions.money import to_usd
from staylake.operators.lookups import (
    DEFAULT_MAX_BROADCAST_ROWS,
    CheckedLookup,
    check_lookup,
    join_lookup,
)
from staylake.operators.rates import all_usd_rates
from staylake.schemas import MAPPED_BOOKING
from staylake.sources.mappings import load_mapping

# The region of an unmapped country, the revenue of a booking, the mapping files.
REGION_DEFAULT = "other"
REVENUE_DEFAULT = 0.0
STATUS_FILE, REGION_FILE = "status_mapping.json", "country_region.json"


@dataclass(frozen=True)
class Lookups:
    """The three lookup tables, each checked for unique keys and size."""

    status: CheckedLookup
    region: CheckedLookup
    rates: CheckedLookup

    @classmethod
    def of(
        cls,
        status: DataFrame,
        region: DataFrame,
        rates: DataFrame,
        max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    ) -> Lookups:
        """``status``/``region`` are ``(key, value)``; ``rates`` is ``(currency, rate_to_usd)``."""
        return cls(
            check_lookup(status, "key", max_broadcast_rows),
            check_lookup(region, "key", max_broadcast_rows),
            check_lookup(rates.withColumnRenamed("currency", "key").withColumnRenamed("rate_to_usd", "value"), "key", max_broadcast_rows),
        )


def load_lookups(spark: SparkSession, mappings_dir: str, quotes: DataFrame) -> Lookups:
    """Status and region mapping files from ``mappings_dir``, rates from a quotes table."""
    base = mappings_dir.rstrip("/")
    status = load_mapping(spark, f"{base}/{STATUS_FILE}")
    region = load_mapping(spark, f"{base}/{REGION_FILE}")
    return Lookups.of(status, region, all_usd_rates(quotes))


def map_bookings(
    raw: DataFrame,
    lookups: Lookups,
    revenue: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Map raw records to the flat booking schema (``MAPPED_BOOKING`` order).

    ``revenue`` defaults to the constant 0.0; ``revenue_usd`` is revenue in
    USD (null when the currency is missing or has no rate). Columns named in
    ``keep`` are carried through in front of the mapped ones.
    """
    schema = raw.schema  # one fetch for every path below

    def field(path: str) -> Column:
        return safe_path(schema, path, "string")

    label = field("label")
    parts = attribution(label)
    rev = F.lit(REVENUE_DEFAULT) if revenue is None else revenue
    staged = raw.select(
        *[F.col(f"`{k}`") for k in keep],
        field("accommodations.reservation").alias("transaction_id"),
        label.alias("conversion_key"),
        parts["site_key"].alias("site_key"),
        parts["device"].alias("device"),
        parts["referral_property_id"].alias("referral_property_id"),
        prefixed_id(field("accommodation_details.accommodation")).alias("property_id"),
        field("status").alias("__status_raw"),
        field("booker.travel_purpose").alias("travel_purpose"),
        country_code(field("booker.address.country")).alias("country_code"),
        field("currencies.booker").alias("currency"),
        date_only(field("start")).alias("check_in_date"),
        date_only(field("end")).alias("check_out_date"),
        rev.cast("double").alias("revenue"),
    )
    j1, status_value, status_hit = join_lookup(staged, F.col("__status_raw"), lookups.status)
    j2, region_value, region_hit = join_lookup(j1, F.col("country_code"), lookups.region)
    j3, rate_value, rate_hit = join_lookup(j2, F.upper(F.col("currency")), lookups.rates)
    derived = {
        "status": F.when(status_hit, status_value).otherwise(F.col("__status_raw")),
        "region": F.when(region_hit, region_value).otherwise(F.lit(REGION_DEFAULT)),
        "revenue_usd": to_usd(F.col("revenue"), F.when(rate_hit, rate_value)),
    }
    out = [derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in MAPPED_BOOKING.fields]
    return j3.select(*[F.col(f"`{k}`") for k in keep], *out)


def transform_sample(raw: DataFrame, lookups: Lookups, n: int = 100, key: str | None = None) -> DataFrame:
    """Map ``n`` raw records, a dry run before a full load.

    With ``key`` the sample is the first ``n`` records by that key: the same
    rows every time, found with a per-task top-n over the whole input. With
    ``key=None`` it is any ``n`` records: a plain limit, which stops reading
    as soon as it has them.
    """
    picked = raw.limit(n) if key is None else raw.orderBy(F.asc_nulls_last(key)).limit(n)
    return map_bookings(picked, lookups)
