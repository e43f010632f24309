"""Relational operators: lookups, rates, rejects, audit."""

from staylake.operators.audit import audit, breakdown_by, describe_table, row_count, sample_rows
from staylake.operators.lookups import (
    DEFAULT_MAX_BROADCAST_ROWS,
    CheckedLookup,
    check_lookup,
    lookup,
    lookup_or_default,
    lookup_or_keep,
)
from staylake.operators.rates import (
    all_usd_rates,
    check_rates,
    convert_amount,
    missing_rates,
    usd_rates,
    wanted_currencies,
)
from staylake.operators.rejects import MALFORMED, split_rejects

__all__ = [
    "DEFAULT_MAX_BROADCAST_ROWS",
    "MALFORMED",
    "CheckedLookup",
    "all_usd_rates",
    "audit",
    "breakdown_by",
    "check_lookup",
    "check_rates",
    "convert_amount",
    "describe_table",
    "lookup",
    "lookup_or_default",
    "lookup_or_keep",
    "missing_rates",
    "row_count",
    "sample_rows",
    "split_rejects",
    "usd_rates",
    "wanted_currencies",
]
