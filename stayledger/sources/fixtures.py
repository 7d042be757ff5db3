"""Booking fixtures derived from the driver tables ``orders`` and ``customer``.

One booking per order. The same rows are produced by the portable SQL in
``FIXTURES_FLAT_SQL`` (DuckDB / Spark SQL), which the oracle queries embed.
Everything here is lazy DataFrame code, so the fixture grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture (chosen to cover mapped, unmapped, wrong-case and
# non-ISO codes). Each list is indexed by a key modulo its length.
TRAVEL_PURPOSES = ["leisure", "business", ""]
COUNTRIES = [
    "de", "GB", "us", "FR", "nl", "ES", "it", "TR", "in", "JP", "br", "MX", "au",
    "NZ", "za", "EG", "ae", "SA", "UK", "CA", "jm", "XA", "ZZ", "NA", "ch",
]
CURRENCIES = ["EUR", "USD", "GBP", "CHF"]
SITES = ["alpha", "beta", "gamma"]
DEVICE_CODES = ["m", "d", "t", "x"]
STATUSES = [
    "cancelled_by_hotel", "cancelled_by_accommodation", "cancelled_by_guest", "no_show",
    "stayed", "booked", "S", "F", "C", "cancelled", "Stayed", "modified",
]
USD_RATE = 1.0837
#: Dollars for one unit; CHF has none on purpose.
USD_RATES = {"EUR": 1.0837, "USD": 1.0, "GBP": 1.2694}

# Region of each upper-cased country code the fixture uses, as in
# the original region mapping (ZZ is absent there on purpose).
FIXTURE_REGIONS: dict[str, str] = {
    "DE": "Europe", "GB": "Europe", "US": "Northern America", "FR": "Europe",
    "NL": "Europe", "ES": "Europe", "IT": "Europe", "TR": "Asia", "IN": "Asia",
    "JP": "Asia", "BR": "Latin America", "MX": "Latin America", "AU": "Oceania",
    "NZ": "Oceania", "ZA": "Africa", "EG": "Africa", "AE": "Asia", "SA": "Asia",
    "UK": "Europe", "CA": "Northern America", "JM": "Caribbean", "XA": "other",
    "NA": "Africa", "CH": "Europe",
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], idx: Column) -> Column:
    """values[idx] for a 0-based integer column (split_part is 1-based)."""
    return F.split_part(F.lit(",".join(values)), F.lit(","), idx.cast("int") + 1)


def flat_bookings(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Flat booking rows: one per order, joined to its customer's nation."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = customer.select("c_custkey", "c_nationkey")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    label = F.concat(
        F.lit("k-"), _pick(SITES, key % 3),
        F.lit("_d-"), _pick(DEVICE_CODES, key % 4),
        F.lit("_p-BC-"), cust.cast("string"),
    )
    return o.join(c, o.o_custkey == c.c_custkey).select(
        key.cast("string").alias("id"),
        key.alias("reservation"),
        cust.alias("accommodation"),
        _pick(TRAVEL_PURPOSES, key % 3).alias("travel_purpose"),
        _pick(COUNTRIES, F.col("c_nationkey")).alias("country"),
        _pick(CURRENCIES, cust % 4).alias("currency"),
        (F.col("o_totalprice") * 0.1).alias("commission_amount"),
        F.col("o_totalprice").alias("price_total"),
        F.concat(day.cast("string"), F.lit("T14:00:00")).alias("start_s"),
        F.when(key % 97 == 0, F.lit("unknown"))
        .otherwise(F.date_add(day, 3).cast("string")).alias("end_s"),
        F.when(key % 11 == 0, F.lit("direct")).otherwise(label).alias("label"),
        _pick(STATUSES, key % 12).alias("status"),
    )


def nest(flat: DataFrame) -> DataFrame:
    """Nested raw bookings in the shape of the JSON contract."""
    return flat.select(
        "id",
        F.struct(F.col("reservation")).alias("accommodations"),
        F.struct(F.col("accommodation")).alias("accommodation_details"),
        F.struct(
            F.struct(F.col("country")).alias("address"), F.col("travel_purpose")
        ).alias("booker"),
        F.struct(
            F.struct(F.col("commission_amount").alias("booker_currency")).alias(
                "estimate_commission_amount"
            )
        ).alias("commission"),
        F.struct(F.col("currency").alias("booker")).alias("currencies"),
        F.col("start_s").alias("start"),
        F.col("end_s").alias("end"),
        "label",
        F.struct(F.col("price_total").alias("total")).alias("price"),
        "status",
    )


def damage(flat: DataFrame) -> DataFrame:
    """Break value rules on purpose, for the quality checks.

    Lower-case currency when reservation % 13 = 0, negate the commission when
    % 17 = 0, NaN when % 29 = 0, null when % 19 = 0, and add a second copy of
    every row with % 23 = 0 (duplicate keys). No row is dropped.
    """
    r = F.col("reservation")
    amount = F.col("commission_amount")
    amount = F.when(r % 17 == 0, -amount).otherwise(amount)
    amount = F.when(r % 29 == 0, F.lit(float("nan"))).otherwise(amount)
    amount = F.when(r % 19 == 0, F.lit(None).cast("double")).otherwise(amount)
    out = flat.withColumns({
        "currency": F.when(r % 13 == 0, F.lower("currency")).otherwise(F.col("currency")),
        "commission_amount": amount,
    })
    return out.unionByName(out.filter(r % 23 == 0))


def raw_bookings(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """Nested raw bookings from the driver tables at ``sf_dir``."""
    flat = flat_bookings(driver_table(spark, sf_dir, "orders"), driver_table(spark, sf_dir, "customer"))
    return nest(damage(flat) if damaged else flat)


# Portable SQL of ``flat_bookings`` for DuckDB oracles (one CTE).
FLAT_SQL = """
flat_bookings AS (
  SELECT cast(o.o_orderkey AS varchar) AS id,
    o.o_orderkey AS reservation,
    o.o_custkey AS accommodation,
    split_part('leisure,business,', ',', cast(o.o_orderkey % 3 AS int) + 1) AS travel_purpose,
    split_part('de,GB,us,FR,nl,ES,it,TR,in,JP,br,MX,au,NZ,za,EG,ae,SA,UK,CA,jm,XA,ZZ,NA,ch', ',', c.c_nationkey + 1) AS country,
    split_part('EUR,USD,GBP,CHF', ',', cast(o.o_custkey % 4 AS int) + 1) AS currency,
    o.o_totalprice * 0.1 AS commission_amount,
    o.o_totalprice AS price_total,
    concat(cast(cast(o.o_orderdate AS date) AS varchar), 'T14:00:00') AS start_s,
    CASE WHEN o.o_orderkey % 97 = 0 THEN 'unknown'
         ELSE cast(cast(o.o_orderdate + INTERVAL 3 DAY AS date) AS varchar) END AS end_s,
    CASE WHEN o.o_orderkey % 11 = 0 THEN 'direct'
         ELSE concat('k-', split_part('alpha,beta,gamma', ',', cast(o.o_orderkey % 3 AS int) + 1),
                     '_d-', split_part('m,d,t,x', ',', cast(o.o_orderkey % 4 AS int) + 1),
                     '_p-BC-', cast(o.o_custkey AS varchar)) END AS label,
    split_part('cancelled_by_hotel,cancelled_by_accommodation,cancelled_by_guest,no_show,stayed,booked,S,F,C,cancelled,Stayed,modified', ',', cast(o.o_orderkey % 12 AS int) + 1) AS status
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

DAMAGED_SQL = """
damaged_base AS (
  SELECT * REPLACE (
    CASE WHEN reservation % 13 = 0 THEN lower(currency) ELSE currency END AS currency,
    CASE WHEN reservation % 19 = 0 THEN NULL
         WHEN reservation % 29 = 0 THEN 'nan'::double
         WHEN reservation % 17 = 0 THEN -commission_amount
         ELSE commission_amount END AS commission_amount)
  FROM flat_bookings
),
damaged AS (
  SELECT * FROM damaged_base UNION ALL SELECT * FROM damaged_base WHERE reservation % 23 = 0
)"""
