"""Column-expression builders (no UDFs)."""

from staylake.functions.fields import (
    blank_to_null,
    country_code,
    date_only,
    month_of,
    prefixed_id,
    safe_path,
)
from staylake.functions.labels import DEVICE_NAMES, attribution, device_name, label_part
from staylake.functions.money import invert_quote, to_usd

__all__ = [
    "DEVICE_NAMES",
    "attribution",
    "blank_to_null",
    "country_code",
    "date_only",
    "device_name",
    "invert_quote",
    "label_part",
    "month_of",
    "prefixed_id",
    "safe_path",
    "to_usd",
]
