"""Exchange rates: wanted currencies, USD rates, gaps, and conversion.

The input is a quotes table ``(currency, usd_to_ccy)`` in the form a rate
service publishes it (one USD buys ``usd_to_ccy`` units). The rules:

* wanted currencies are the distinct non-empty booking currencies, upper-cased;
* nothing wanted gives no rates at all; anything wanted adds ``USD = 1.0``;
* other wanted currencies get ``1 / usd_to_ccy``; a zero or null quote is
  skipped, so that currency ends up missing;
* a conversion with no rate (or no currency) gives null.

Everything stays a DataFrame; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.functions.money import invert_quote, to_usd
from staylake.operators.lookups import DEFAULT_MAX_BROADCAST_ROWS, CheckedLookup, check_lookup
from staylake.schemas import USD_RATES

BASE = "USD"


def wanted_currencies(df: DataFrame, currency: Column | str) -> DataFrame:
    """Distinct upper-cased currencies, nulls and empty strings dropped: ``(currency)``."""
    c = F.col(currency) if isinstance(currency, str) else currency
    code = F.upper(c).alias("currency")
    return df.select(code).where(F.col("currency").isNotNull() & (F.col("currency") != "")).distinct()


def _fetched(quotes: DataFrame) -> DataFrame:
    """Non-base quotes inverted to currency->USD; zero and null quotes dropped."""
    q = quotes.select(F.upper(F.col("currency")).alias("currency"), F.col("usd_to_ccy"))
    inverted = q.where(F.col("currency") != BASE).select("currency", invert_quote(F.col("usd_to_ccy")).alias("rate_to_usd"))
    return inverted.where(F.col("rate_to_usd").isNotNull())


def usd_rates(quotes: DataFrame, wanted: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Currency->USD rates for exactly the wanted currencies: ``(currency, rate_to_usd)``.

    One pass over ``wanted``: each wanted currency is emitted together with
    ``USD`` and deduplicated, so USD is present exactly when anything is
    wanted; the quotes (size-checked, broadcast when small) are then joined
    on. Wanted currencies without a usable quote drop out.
    """
    keys = wanted.select(F.explode(F.array(F.col("currency"), F.lit(BASE))).alias("currency")).distinct()
    checked = check_rates(_fetched(quotes), max_broadcast_rows)
    fetched = checked.frame.select("currency", F.col("rate_to_usd").alias("__quoted"))
    if checked.broadcast:
        fetched = F.broadcast(fetched)
    rate = F.when(F.col("currency") == BASE, F.lit(1.0)).otherwise(F.col("__quoted"))
    joined = keys.join(fetched, "currency", "left")
    return joined.select("currency", rate.alias("rate_to_usd")).where(F.col("rate_to_usd").isNotNull())


def all_usd_rates(quotes: DataFrame) -> DataFrame:
    """Currency->USD rates for every quoted currency, plus ``USD = 1.0``.

    Joining bookings against this gives the same result as against
    ``usd_rates(quotes, wanted_currencies(bookings))``: a booking's currency
    is wanted by definition, and USD is present whenever any booking has a
    currency. It saves the extra pass over the bookings that the wanted set
    costs.
    """
    base = quotes.sparkSession.createDataFrame([(BASE, 1.0)], USD_RATES)
    return _fetched(quotes).unionByName(base)


def missing_rates(wanted: DataFrame, rates: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Wanted non-base currencies that got no rate: ``(currency)``.

    ``rates`` may be ``all_usd_rates(quotes)``: the answer is the same as
    with ``usd_rates(quotes, wanted)`` and ``wanted`` is computed only once.
    """
    checked = check_rates(rates, max_broadcast_rows)
    have = checked.frame.select("currency")
    if checked.broadcast:
        have = F.broadcast(have)
    return wanted.where(F.col("currency") != BASE).join(have, "currency", "left_anti")


def check_rates(rates: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> CheckedLookup:
    """Unique-currency and size check for a rates table."""
    return check_lookup(rates, key="currency", max_broadcast_rows=max_broadcast_rows)


def convert_amount(
    df: DataFrame,
    amount: Column,
    currency: Column,
    rates: DataFrame | CheckedLookup,
    out: str,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``out`` = amount in USD, rounded half-up to cents; rate looked up case-insensitively."""
    checked = rates if isinstance(rates, CheckedLookup) else check_rates(rates, max_broadcast_rows)
    r = checked.frame.select(F.col("currency").alias("__rate_ccy"), F.col("rate_to_usd").alias("__rate"))
    if checked.broadcast:
        r = F.broadcast(r)
    joined = df.join(r, F.upper(currency) == F.col("__rate_ccy"), "left")
    return joined.withColumn(out, to_usd(amount, F.col("__rate"))).drop("__rate_ccy", "__rate")
