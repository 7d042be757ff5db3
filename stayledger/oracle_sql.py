"""DuckDB oracle SQL for the registered queries.

Each statement runs on the driver tables (``orders``, ``customer`` ...) as
views, rebuilds the booking fixture with ``FLAT_SQL`` and states the expected
result of the matching Spark query in plain SQL.
"""

from __future__ import annotations

from .functions.columns import CURRENCY_PATTERN, DEVICE_NAMES, LABEL_DEVICE_PATTERN, \
    LABEL_REFERRAL_PATTERN, LABEL_SITE_PATTERN, PROPERTY_PREFIX
from .sources.fixtures import DAMAGED_SQL, FIXTURE_REGIONS, FLAT_SQL, USD_RATE, USD_RATES
from .sources.lookups import STATUS_MAPPING


def _values(mapping: dict[str, str], cols: str) -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())
    return f"SELECT * FROM (VALUES {rows}) AS t({cols})"


LOOKUPS_SQL = f"""
status_map AS ({_values(STATUS_MAPPING, "raw_status, mapped_status")}),
region_map AS ({_values(FIXTURE_REGIONS, "country_code, region")})"""

_DEVICE_CASE = "CASE " + " ".join(
    f"WHEN {{code}} = '{k}' THEN '{v}'" for k, v in DEVICE_NAMES.items()
) + " ELSE {code} END"


def transform_sql(source: str = "flat_bookings") -> str:
    """The 15-column transform of a flat booking relation, as a SELECT."""
    code = f"regexp_extract(f.label, '{LABEL_DEVICE_PATTERN}', 1)"
    return f"""
  SELECT f.reservation AS transaction_id,
    f.label AS conversion_key,
    '{PROPERTY_PREFIX}' || cast(f.accommodation AS varchar) AS property_id,
    coalesce(s.mapped_status, f.status) AS status,
    f.travel_purpose AS travel_purpose,
    upper(f.country) AS country_code,
    r.region AS region,
    f.currency AS currency,
    try_cast(f.start_s AS date) AS check_in_date,
    try_cast(f.end_s AS date) AS check_out_date,
    upper(regexp_extract(f.label, '{LABEL_SITE_PATTERN}', 1)) AS site_key,
    {_DEVICE_CASE.format(code=code)} AS device,
    regexp_extract(f.label, '{LABEL_REFERRAL_PATTERN}', 1) AS referral_property_id,
    f.commission_amount AS revenue,
    round(f.commission_amount * {USD_RATE}::double, 2) AS revenue_usd
  FROM {source} f
  LEFT JOIN status_map s ON f.status = s.raw_status
  LEFT JOIN region_map r ON upper(f.country) = r.country_code"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


CTES = (
    FLAT_SQL, LOOKUPS_SQL, f"\nbookings AS ({transform_sql()})", DAMAGED_SQL,
    f"\ndamaged_bookings AS ({transform_sql('damaged')})",
)


def q(body: str) -> str:
    """A statement over the fixture CTEs (flat_bookings, bookings, damaged_bookings...)."""
    return with_ctes(*CTES, body=body)


def cols(*names: str, source: str = "bookings") -> str:
    return f"SELECT {', '.join(names)} FROM {source}"


MAP_STATUS = """SELECT f.reservation AS transaction_id, f.status AS raw_status,
  coalesce(s.mapped_status, f.status) AS status
FROM flat_bookings f LEFT JOIN status_map s ON f.status = s.raw_status"""

MAP_REGION = """SELECT f.reservation AS transaction_id, upper(f.country) AS country_code, r.region AS region
FROM flat_bookings f LEFT JOIN region_map r ON upper(f.country) = r.country_code"""

_REQUIRED = [
    ("id", "string"), ("accommodations", "struct"), ("accommodation_details", "struct"),
    ("booker", "struct"), ("commission", "struct"), ("currencies", "struct"),
    ("start", "string"), ("end", "string"), ("label", "string"), ("price", "struct"),
    ("status", "string"),
]
_schema_rows = [f"(2, 'column_present', '{c}', 'present', 'present', true)" for c, _ in _REQUIRED]
_schema_rows += [f"(3, 'column_type', '{c}', '{t}', '{t}', true)" for c, t in _REQUIRED]
_schema_rows += ["(4, 'revenue_type', 'commission.estimate_commission_amount.booker_currency', "
                 "'double', 'double', true)"]
SCHEMA_REPORT = q(f"""SELECT 1 AS check_order, 'not_empty' AS check_name, NULL::varchar AS column_name,
  'rows' AS expected, CASE WHEN count(*) > 0 THEN 'rows' ELSE 'empty' END AS actual,
  count(*) > 0 AS passed FROM flat_bookings
UNION ALL
SELECT * FROM (VALUES {", ".join(_schema_rows)})
  AS t(check_order, check_name, column_name, expected, actual, passed)""")

_NEG = "(revenue < 0 OR revenue_usd < 0)"
_CUR = f"NOT regexp_matches(currency, '{CURRENCY_PATTERN}')"
_MISS = "(revenue IS NULL OR isnan(revenue))"

DQ_DUPLICATES = q("""SELECT transaction_id, count(*) AS n FROM damaged_bookings
GROUP BY transaction_id HAVING count(*) > 1""")
DQ_NEGATIVE = q(f"SELECT transaction_id, revenue, revenue_usd FROM damaged_bookings WHERE {_NEG}")
DQ_CURRENCY = q(f"SELECT transaction_id, currency FROM damaged_bookings WHERE {_CUR}")
DQ_MISSING = q(f"""SELECT transaction_id, coalesce(isnan(revenue), false) AS revenue_is_nan
FROM damaged_bookings WHERE {_MISS}""")
DQ_REPORT = q(f"""SELECT * FROM (VALUES
  (1, 'duplicate_keys', (SELECT count(*) FROM (SELECT transaction_id FROM damaged_bookings
                         GROUP BY transaction_id HAVING count(*) > 1))),
  (2, 'negative_revenue', (SELECT count(*) FROM damaged_bookings WHERE {_NEG})),
  (3, 'invalid_currency', (SELECT count(*) FROM damaged_bookings WHERE {_CUR})),
  (4, 'missing_revenue', (SELECT count(*) FROM damaged_bookings WHERE {_MISS}))
) AS t(check_order, check_name, bad_count)""")

_RATES = ", ".join(f"('{c}', {r}::double)" for c, r in USD_RATES.items())


def by_currency(source: str, amount: str = "round(b.revenue * r.usd_rate, 2)") -> str:
    """``source`` with dollars by the rate of each row's currency."""
    return f"""SELECT b.* REPLACE ({amount} AS revenue_usd)
FROM {source} b LEFT JOIN (VALUES {_RATES}) AS r(currency, usd_rate) ON b.currency = r.currency"""


# Spark rounds the decimal text of a double half up; DuckDB does so for decimals only
_HALF_UP = "round(CAST(CAST(b.revenue * r.usd_rate AS varchar) AS decimal(38, 18)), 2)::double"
REVENUE_BY_CURRENCY = q(f"SELECT transaction_id, currency, revenue, revenue_usd FROM ({by_currency('bookings', _HALF_UP)})")
DQ_BY_CURRENCY = q(f"""SELECT * FROM (WITH d AS ({by_currency('damaged_bookings')}) SELECT * FROM (VALUES
  (1, 'duplicate_keys', (SELECT count(*) FROM (SELECT transaction_id FROM d GROUP BY transaction_id HAVING count(*) > 1))),
  (2, 'negative_revenue', (SELECT count(*) FROM d WHERE {_NEG})),
  (3, 'invalid_currency', (SELECT count(*) FROM d WHERE {_CUR})),
  (4, 'missing_revenue', (SELECT count(*) FROM d WHERE {_MISS})),
  (5, 'missing_rate', (SELECT count(*) FROM d WHERE revenue IS NOT NULL AND revenue_usd IS NULL))
) AS t(check_order, check_name, bad_count))""")

# a table of every third key, then all bookings in two batches of even and odd keys
SYNC_SINCE_BIRTH = q("""SELECT * FROM bookings WHERE transaction_id % 2 = 0
UNION ALL
SELECT * FROM bookings WHERE transaction_id % 3 <> 0""")
SYNC_SINCE_BIRTH_ONCE = q("SELECT * FROM bookings WHERE transaction_id % 2 = 0 OR transaction_id % 3 <> 0")

BATCH_SLICE = q("""SELECT cast(transaction_id % 5 AS integer) AS batch, count(*) AS row_count,
  cast(sum(transaction_id) AS bigint) AS key_sum FROM bookings GROUP BY 1""")

UPSERT = q("""SELECT * FROM bookings WHERE transaction_id % 5 NOT IN (3, 4)
UNION ALL
SELECT * REPLACE (revenue + 1 AS revenue) FROM bookings WHERE transaction_id % 5 IN (3, 4)""")

UPSERT_CHANGES = q("""SELECT *, 'UPDATE_BEFORE' AS _change_type, 0 AS _change_ordinal,
  2::bigint AS _commit_snapshot_id FROM bookings WHERE transaction_id % 5 = 3
UNION ALL
SELECT * REPLACE (revenue + 1 AS revenue),
  CASE WHEN transaction_id % 5 = 3 THEN 'UPDATE_AFTER' ELSE 'INSERT' END AS _change_type,
  0 AS _change_ordinal, 2::bigint AS _commit_snapshot_id
FROM bookings WHERE transaction_id % 5 IN (3, 4)""")

COMMIT_LOG = q("""SELECT cast(b + 1 AS bigint) AS commit_id,
  CASE WHEN b = 0 THEN 'create' ELSE 'upsert' END AS operation,
  n AS source_rows, n AS inserted, 0::bigint AS updated,
  cast(sum(n) OVER (ORDER BY b) AS bigint) AS row_count
FROM (SELECT transaction_id % 5 AS b, count(*) AS n FROM bookings GROUP BY 1)""")

FIRST_LAST = q("""SELECT min(b) + 1 AS first_commit, max(b) + 1 AS last_commit
FROM (SELECT DISTINCT cast(transaction_id % 5 AS bigint) AS b FROM bookings)""")

CHANGELOG_RANGE = q("""SELECT *, 'INSERT' AS _change_type,
  cast(transaction_id % 5 - 1 AS integer) AS _change_ordinal,
  cast(transaction_id % 5 + 1 AS bigint) AS _commit_snapshot_id
FROM bookings WHERE transaction_id % 5 <> 0""")

SYNC_AUDIT = q("""SELECT 1::bigint AS snapshot_id, 'first' AS batch_label, count(*) AS record_count,
  'done' AS status FROM bookings WHERE transaction_id % 5 = 0
UNION ALL
SELECT 5::bigint, 'last', count(*), 'done' FROM bookings WHERE transaction_id % 5 <> 0""")
