"""DuckDB SQL with the expected result of each registered query.

Written independently of the Spark code from the mapping rules, over the
same driver tables (views ``orders``, ``customer``, ``nation``, ``region``,
``events``). Shared pieces are composed as CTEs.

The Spark queries always run on every booking. The only ``id % 37`` below
states which records the fixture cut short (so which ones the Spark job must
reject); it is the expected answer, not a subset of the input.
"""

from __future__ import annotations

# Raw bookings, flat (FIXTURES.md section 4, DuckDB dialect).
FLAT = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'organic'
    ELSE concat(CASE WHEN o_orderkey % 19 = 0 THEN 'k-first_' ELSE '' END,
      'k-', lower(c_mktsegment), '_d-',
      CASE o_orderkey % 4 WHEN 0 THEN 'm' WHEN 1 THEN 'd' WHEN 2 THEN 't' ELSE 'tv' END,
      '_u-', cast(c_custkey AS VARCHAR), '_p-BC-', cast(o_orderkey % 500 AS VARCHAR)) END AS label,
  o_orderstatus AS status,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS start_ts,
  strftime(o_orderdate + to_days(cast(1 + o_orderkey % 14 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS end_ts,
  CASE o_orderkey % 3 WHEN 0 THEN 'business' WHEN 1 THEN 'leisure' END AS travel_purpose,
  CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE lower(n_name) END AS country,
  CASE n_nationkey % 6 WHEN 0 THEN 'EUR' WHEN 1 THEN 'usd' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' WHEN 4 THEN 'ZZZ' END AS currency,
  o_orderkey AS reservation,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_custkey END AS accommodation,
  o_totalprice AS amount
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

# Country -> region lookup of the fixture.
REGIONS = """
SELECT upper(n_name) AS k, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

QUOTES = """
SELECT * FROM (VALUES ('EUR', CAST(0.92 AS DOUBLE)), ('GBP', CAST(0.79 AS DOUBLE)),
                      ('JPY', CAST(150.0 AS DOUBLE)), ('CHF', CAST(0.0 AS DOUBLE))) q(ccy, usd_to_ccy)
"""

# Currency -> USD for every quoted currency (zero quotes skipped) plus USD.
ALL_RATES = f"""
SELECT ccy, 1.0 / usd_to_ccy AS usd FROM ({QUOTES}) WHERE usd_to_ccy <> 0
UNION ALL SELECT 'USD', CAST(1.0 AS DOUBLE)
"""


def _part(prefix: str) -> str:
    return f"substr(list_filter(string_split(b.label, '_'), lambda s: starts_with(s, '{prefix}-'))[-1], 3)"


def _usd(amount: str, rate: str) -> str:
    return f"CAST(round(CAST({amount} AS DECIMAL(19,4)) * CAST({rate} AS DECIMAL(18,14)), 2) AS DOUBLE)"


def _mapped(status_case: str) -> str:
    return f"""
SELECT cast(b.id AS VARCHAR) AS id,
  cast(b.reservation AS VARCHAR) AS transaction_id,
  b.label AS conversion_key,
  upper({_part('k')}) AS site_key,
  CASE {_part('d')} WHEN 'm' THEN 'mobile' WHEN 'd' THEN 'desktop' WHEN 't' THEN 'tablet' ELSE {_part('d')} END AS device,
  {_part('p')} AS referral_property_id,
  CASE WHEN b.accommodation IS NULL THEN NULL ELSE concat('BC-', cast(b.accommodation AS VARCHAR)) END AS property_id,
  {status_case} AS status,
  b.travel_purpose,
  nullif(upper(b.country), '') AS country_code,
  CASE WHEN r.k IS NULL THEN 'other' ELSE r.region END AS region,
  b.currency,
  try_cast(split_part(b.start_ts, 'T', 1) AS DATE) AS check_in_date,
  try_cast(split_part(b.end_ts, 'T', 1) AS DATE) AS check_out_date,
  CAST(0.0 AS DOUBLE) AS revenue,
  CASE WHEN rt.usd IS NULL THEN NULL ELSE {_usd('0.0', 'rt.usd')} END AS revenue_usd
FROM ({FLAT}) b
LEFT JOIN ({REGIONS}) r ON nullif(upper(b.country), '') = r.k
LEFT JOIN ({ALL_RATES}) rt ON upper(b.currency) = rt.ccy
"""


STATUS = "CASE b.status WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'pending' ELSE b.status END"
STATUS_P_NULL = "CASE b.status WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'pending' WHEN 'P' THEN NULL ELSE b.status END"

MAPPED_WITH_ID = _mapped(STATUS)
MAPPED_COLUMNS = (
    "transaction_id, conversion_key, site_key, device, referral_property_id, property_id, status, "
    "travel_purpose, country_code, region, currency, check_in_date, check_out_date, revenue, revenue_usd"
)
MAPPED = f"SELECT {MAPPED_COLUMNS} FROM ({MAPPED_WITH_ID})"
TABLE = f"SELECT {MAPPED_COLUMNS}, CAST(date_trunc('month', check_in_date) AS DATE) AS check_in_month FROM ({MAPPED_WITH_ID})"

WANTED = """
SELECT DISTINCT upper(currency) AS currency FROM ({flat})
WHERE currency IS NOT NULL AND currency <> ''
""".format(flat=FLAT)

USD_RATES = f"""
WITH w AS ({WANTED})
SELECT ccy AS currency, 1.0 / usd_to_ccy AS rate_to_usd
FROM ({QUOTES}) WHERE usd_to_ccy <> 0 AND ccy <> 'USD' AND ccy IN (SELECT currency FROM w)
UNION ALL SELECT 'USD', CAST(1.0 AS DOUBLE) WHERE EXISTS (SELECT 1 FROM w)
"""


def _breakdown(column: str, source: str) -> str:
    return (
        f"SELECT {column}, count(*) AS bookings FROM ({source}) GROUP BY {column} "
        f"ORDER BY bookings DESC, {column} ASC NULLS FIRST"
    )


DESCRIBE_ROWS = [
    ("transaction_id", "string", False),
    ("conversion_key", "string", False),
    ("site_key", "string", False),
    ("device", "string", False),
    ("referral_property_id", "string", False),
    ("property_id", "string", False),
    ("status", "string", False),
    ("travel_purpose", "string", False),
    ("country_code", "string", False),
    ("currency", "string", False),
    ("check_in_date", "date", False),
    ("check_out_date", "date", False),
    ("revenue", "double", False),
    ("revenue_usd", "double", False),
    ("check_in_month", "date", True),
    ("region", "string", True),
]

DESCRIBE = "SELECT * FROM (VALUES {}) t(position, col_name, data_type, is_partition)".format(
    ", ".join(f"({i}, '{n}', '{t}', {str(p).lower()})" for i, (n, t, p) in enumerate(DESCRIBE_ROWS))
)

ORACLE: dict[str, str] = {
    "map_bookings": MAPPED,
    "label_parse": f"SELECT id, conversion_key AS label, site_key, device, referral_property_id FROM ({MAPPED_WITH_ID})",
    "device_codes": f"SELECT device, count(*) AS bookings FROM ({MAPPED_WITH_ID}) GROUP BY device",
    "safe_nested_fields": f"""
        SELECT cast(id AS VARCHAR) AS id, cast(reservation AS VARCHAR) AS transaction_id, travel_purpose, country, currency,
               CAST(NULL AS VARCHAR) AS missing_leaf, CAST(NULL AS VARCHAR) AS through_scalar
        FROM ({FLAT})""",
    "property_ids": f"SELECT id, property_id FROM ({MAPPED_WITH_ID})",
    "country_codes": f"SELECT id, country_code FROM ({MAPPED_WITH_ID})",
    "stay_dates": f"SELECT id, check_in_date, check_out_date FROM ({MAPPED_WITH_ID})",
    "status_lookup": f"SELECT id, status FROM ({MAPPED_WITH_ID})",
    "status_lookup_null_value": f"SELECT id, status FROM ({_mapped(STATUS_P_NULL)})",
    "region_lookup": f"SELECT id, country_code, region FROM ({MAPPED_WITH_ID})",
    "transform_sample": f"SELECT {MAPPED_COLUMNS} FROM ({MAPPED_WITH_ID}) ORDER BY id LIMIT 100",
    "currencies_distinct": WANTED,
    "usd_rates": USD_RATES,
    "usd_rates_empty": "SELECT CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS DOUBLE) AS rate_to_usd WHERE false",
    "usd_rates_zero_quote": f"""
        SELECT ccy AS currency, 1.0 / usd_to_ccy AS rate_to_usd FROM ({QUOTES})
        WHERE usd_to_ccy <> 0 AND ccy IN (SELECT upper(replace(currency, 'usd', 'chf')) FROM ({FLAT}))
        UNION ALL SELECT 'USD', CAST(1.0 AS DOUBLE)""",
    "map_bookings_revenue": f"""
        SELECT cast(b.id AS VARCHAR) AS transaction_id, CAST(b.id % 1000 * 1.25 AS DOUBLE) AS revenue,
               {_usd('b.id % 1000 * 1.25', 'r.usd')} AS revenue_usd
        FROM ({FLAT}) b LEFT JOIN ({ALL_RATES}) r ON upper(b.currency) = r.ccy""",
    "missing_rates": f"""
        WITH w AS ({WANTED}), r AS ({USD_RATES})
        SELECT currency FROM w WHERE currency <> 'USD' AND NOT EXISTS (SELECT 1 FROM r WHERE r.currency = w.currency)""",
    "convert_amount": f"""
        SELECT b.id, {_usd('b.amount', 'r.usd')} AS amount_usd
        FROM ({FLAT}) b LEFT JOIN ({ALL_RATES}) r ON upper(b.currency) = r.ccy""",
    "rejects": f"SELECT cast(id AS VARCHAR) AS id, 'malformed_json' AS reason FROM ({FLAT}) WHERE id % 37 = 0",
    "json_lines_roundtrip": MAPPED,
    "json_array_scan": MAPPED,
    "json_array_lines_scan": MAPPED,
    "json_array_rewrite": MAPPED,
    "json_line_hazards": f"""
        SELECT CASE WHEN id % 11 = 3 THEN NULL ELSE cast(id AS VARCHAR) END AS id,
               CASE WHEN id % 11 IN (0, 1, 3, 4) THEN 'malformed_json' ELSE 'booked' END AS outcome,
               sum(CASE WHEN id % 11 = 2 THEN 2 ELSE 1 END)::BIGINT AS records
        FROM ({FLAT}) GROUP BY 1, 2""",
    "json_array_broken": """
        SELECT cast(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 13 < 2 THEN 'malformed_json' ELSE 'booked' END AS outcome,
               count(*) AS records
        FROM orders GROUP BY 1, 2""",
    "number_rewrite": """
        WITH o AS (SELECT o_orderkey + 1 AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
        SELECT concat('{"id":', k, ',"a":', c // 100,
                      CASE WHEN c % 100 = 0 THEN '' WHEN c % 10 = 0 THEN concat('.', c % 100 // 10) ELSE concat('.', lpad(cast(c % 100 AS VARCHAR), 2, '0')) END,
                      ',"b":', k, '000,"c":', k * 10 + 5, ',"d":"', k, '.50 ","e":', k, repeat('7', 40), ',"f":0}') AS value
        FROM o""",
    "schema_drift": """
        SELECT 'channel' AS path, CAST(NULL AS VARCHAR) AS expected, 'STRING' AS found, count(*) AS records FROM orders WHERE o_orderkey % 7 = 0
        UNION ALL SELECT 'label', 'SCALAR', 'OBJECT', count(*) FROM orders WHERE o_orderkey % 11 = 0
        UNION ALL SELECT 'booker', 'OBJECT', 'BIGINT', count(*) FROM orders WHERE o_orderkey % 13 = 0""",
    "large_lookup": """
        WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 <> 0 THEN '1' WHEN o_orderkey % 3 = 0 THEN concat('x', o_custkey)
                     WHEN o_orderkey % 7 <> 0 THEN cast(o_custkey AS VARCHAR) END AS code FROM orders)
        SELECT o.id, o.code, CASE WHEN c_custkey IS NULL THEN o.code ELSE c_mktsegment END AS kept,
               CASE WHEN c_custkey IS NULL THEN 'none' ELSE c_mktsegment END AS segment
        FROM o LEFT JOIN customer ON o.code = cast(c_custkey AS VARCHAR)""",
    "mapping_load": f"SELECT k AS key, region AS value FROM ({REGIONS})",
    "lookups_from_files": MAPPED,
    "events_props": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "write_overwrite": TABLE,
    "write_append": f"SELECT * FROM ({TABLE}) UNION ALL SELECT * FROM ({TABLE})",
    "run_history": f"""
        WITH c AS (SELECT count(*) FILTER (WHERE id % 37 <> 0) AS ok, count(*) FILTER (WHERE id % 37 = 0) AS bad FROM ({FLAT}))
        SELECT 'overwrite' AS mode, ok AS rows_written, bad AS rows_rejected FROM c
        UNION ALL SELECT 'append', ok, bad FROM c""",
    "load_table": f"SELECT * FROM ({TABLE}) WHERE CAST(transaction_id AS BIGINT) % 37 <> 0",
    "incremental_append": TABLE,
    "load_retried": f"SELECT * FROM ({TABLE}) WHERE CAST(transaction_id AS BIGINT) % 37 <> 0",
    "stream_duplicates": TABLE,
    "audit_incremental": f"""
        WITH b AS (SELECT * FROM ({MAPPED}) WHERE CAST(transaction_id AS BIGINT) % 37 <> 0)
        SELECT 'row_count' AS "check", CAST(NULL AS VARCHAR) AS key, 3 * count(*) AS n FROM b
        UNION ALL SELECT 'by_region', region, 3 * count(*) FROM b GROUP BY region
        UNION ALL SELECT 'by_status', status, 3 * count(*) FROM b GROUP BY status
        UNION ALL SELECT 'by_device', device, 3 * count(*) FROM b GROUP BY device
        UNION ALL SELECT 'by_country_code', country_code, 3 * count(*) FROM b GROUP BY country_code""",
    "refused_mode": f"SELECT unnest(['merge', '', 'APPEND']) AS mode, cnt FROM (SELECT count(*) AS cnt FROM ({MAPPED}))",
    "sanity_table": "SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name FROM region",
    "wanted_scan": f"""
        SELECT t.* FROM ({TABLE}) t
        WHERE year(check_in_month) = (SELECT year(min(o_orderdate)) FROM orders)
          AND region IN (SELECT r_name FROM region WHERE r_regionkey % 2 = 0)""",
    "pruned_scan": f"""
        SELECT * FROM ({TABLE})
        WHERE check_in_date BETWEEN DATE '1995-03-15' AND DATE '1996-08-31'
          AND region IN ('ASIA', 'EUROPE', 'other')""",
    "row_count": f"SELECT count(*) AS cnt FROM ({MAPPED})",
    "breakdown_region": _breakdown("region", MAPPED),
    "breakdown_status": _breakdown("status", MAPPED),
    "breakdown_device": _breakdown("device", MAPPED),
    "breakdown_country": _breakdown("country_code", MAPPED),
    "sample_rows": f"SELECT * FROM ({TABLE}) ORDER BY transaction_id LIMIT 5",
    "sample_count": f"SELECT count(*) AS cnt FROM (SELECT 1 FROM ({MAPPED_WITH_ID}) LIMIT 100)",
    "describe_table": DESCRIBE,
    "column_profile": f"""
        WITH d AS ({DESCRIBE}),
        n AS (UNPIVOT (SELECT {", ".join(f"count({n}) AS {n}" for n, _, _ in DESCRIBE_ROWS)} FROM ({TABLE})) ON * INTO NAME col_name VALUE filled)
        SELECT position, col_name, data_type, data_type AS stored_type, filled FROM d JOIN n USING (col_name)""",
    "audit_suite": f"""
        SELECT 'row_count' AS "check", CAST(NULL AS VARCHAR) AS key, count(*) AS n FROM ({MAPPED})
        UNION ALL SELECT 'schema', col_name, CAST(position AS BIGINT) FROM ({DESCRIBE})
        UNION ALL SELECT 'sample', transaction_id, CAST(1 AS BIGINT) FROM (SELECT transaction_id FROM ({TABLE}) ORDER BY transaction_id LIMIT 5)
        UNION ALL SELECT 'by_region', region, count(*) FROM ({MAPPED}) GROUP BY region
        UNION ALL SELECT 'by_status', status, count(*) FROM ({MAPPED}) GROUP BY status
        UNION ALL SELECT 'history', 'overwrite', count(*) FROM ({MAPPED})""",
    "orders_breakdown_priority": _breakdown("o_orderpriority", "SELECT * FROM orders"),
    "events_breakdown_type": _breakdown("event_type", "SELECT * FROM events"),
}
