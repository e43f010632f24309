"""Currency arithmetic, in exact decimals wherever they fit.

Amounts and rates are multiplied as decimals and rounded half-up to cents,
then returned as double. Widths are chosen so the product is exact in Spark
(19 + 18 + 1 = 38 digits, scale 18), so there is no intermediate rounding
before the final one. Amounts keep 4 decimals (three-decimal currencies stay
exact); rates keep 14, enough for currencies worth 1/100000 USD on amounts of
10^10 units. A rate of 10000 USD or more per unit or below 10^-8, or an amount
of 10^15 or more, does not fit: such a row is computed in doubles. A product
that is no finite number gives null. No value stops the other rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_TYPE = "decimal(19,4)"
RATE_TYPE = "decimal(18,14)"
SMALLEST_EXACT_RATE = 1e-8


def to_usd(amount: Column, rate_to_usd: Column) -> Column:
    """``round(amount * rate, 2)`` half-up; null when either side is null or the product is not finite."""
    rate = F.when((rate_to_usd == 0) | (F.abs(rate_to_usd) >= SMALLEST_EXACT_RATE), rate_to_usd.try_cast(RATE_TYPE))
    exact = F.round(amount.try_cast(AMOUNT_TYPE) * rate, 2).cast("double")
    wide = amount.cast("double") * rate_to_usd.cast("double")
    finite = ~F.isnan(wide) & (F.abs(wide) != float("inf"))
    return F.when(finite, F.coalesce(exact, F.round(wide, 2)))


def invert_quote(usd_to_ccy: Column) -> Column:
    """USD->currency quote turned into a currency->USD rate; 0 or null gives null."""
    return F.try_divide(F.lit(1.0), F.nullif(usd_to_ccy, F.lit(0.0)))
