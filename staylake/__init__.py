"""staylake: a Spark-native booking ETL and audit engine.

Raw nested booking JSON -> checked, flat, typed bookings (attribution label
parsing, status and region lookups, stay dates, USD amounts) -> a table
partitioned by check-in month and region -> audit queries. Every step is a
DataFrame expression or join; no per-row Python runs in the data path.
"""

__version__ = "0.1.0"
