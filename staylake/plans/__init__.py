"""Job-level plans: record mapping, full load."""

from staylake.plans.mapping import Lookups, load_lookups, map_bookings, transform_sample

__all__ = ["Lookups", "load_lookups", "map_bookings", "transform_sample"]
