"""Explicit schemas: raw input, mapped output, rejects, run history, lookups.

Every reader in the package applies an explicit schema; nothing is inferred,
so one odd record can never change the type of a whole column.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

CORRUPT_COLUMN = "_corrupt_record"


def _s(name: str) -> StructField:
    return StructField(name, StringType(), True)


# Raw booking record as it arrives in JSON. Scalars are read as strings:
# numeric ids keep their JSON text ("483720"), which is the text the mapped
# (all-string) output carries.
RAW_BOOKING = StructType(
    [
        _s("id"),
        _s("label"),
        _s("status"),
        _s("start"),
        _s("end"),
        StructField("accommodations", StructType([_s("reservation")]), True),
        StructField("accommodation_details", StructType([_s("accommodation")]), True),
        StructField(
            "booker",
            StructType([_s("travel_purpose"), StructField("address", StructType([_s("country")]), True)]),
            True,
        ),
        StructField("currencies", StructType([_s("booker")]), True),
    ]
)

# Flat mapped booking; field order is the fixed output contract.
MAPPED_BOOKING = StructType(
    [
        _s("transaction_id"),
        _s("conversion_key"),
        _s("site_key"),
        _s("device"),
        _s("referral_property_id"),
        _s("property_id"),
        _s("status"),
        _s("travel_purpose"),
        _s("country_code"),
        _s("region"),
        _s("currency"),
        StructField("check_in_date", DateType(), True),
        StructField("check_out_date", DateType(), True),
        StructField("revenue", DoubleType(), True),
        StructField("revenue_usd", DoubleType(), True),
    ]
)

# Table layout: mapped booking plus the derived month partition column.
PARTITION_COLUMNS = ("check_in_month", "region")
BOOKINGS_TABLE = StructType(MAPPED_BOOKING.fields + [StructField("check_in_month", DateType(), True)])

REJECT = StructType([_s("id"), _s("reason"), _s("raw")])
REJECT_TABLE = StructType(REJECT.fields + [_s("run_id")])

RUN_HISTORY = StructType(
    [
        _s("run_id"),
        StructField("committed_at", TimestampType(), True),
        _s("table"),
        _s("mode"),
        StructField("rows_written", LongType(), True),
        StructField("rows_rejected", LongType(), True),
    ]
)

# Bookings of a run by these columns; sums of such rows are the table's breakdowns.
SUMMARY_KEYS = ("region", "status", "device", "country_code")
SUMMARY = StructType([*[_s(k) for k in SUMMARY_KEYS], StructField("bookings", LongType(), True), _s("run_id")])

MAPPING = StructType([_s("key"), _s("value")])

# Quotes as the rate service returns them: 1 USD buys `usd_to_ccy` units.
QUOTES = StructType([_s("currency"), StructField("usd_to_ccy", DoubleType(), True)])

# Currency -> USD multiplier, the form the mapping joins against.
USD_RATES = StructType([_s("currency"), StructField("rate_to_usd", DoubleType(), True)])
