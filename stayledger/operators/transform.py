"""The booking transform: raw nested records -> 15-column booking table.

Each step is a ``DataFrame -> DataFrame`` function for ``df.transform``.
Lookup joins carry no hint: code tables are small enough for the planner to
broadcast, so the whole chain is one scan plus narrow, codegen'd operators.
Intermediate columns carry a ``_`` prefix so raw columns of the same name
(for instance a top-level ``region``) cannot make the final select ambiguous.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.lookups import unique_keys

# The output contract, in order, and the raw leaf revenue is read from.
BOOKING_COLUMNS = [
    "transaction_id", "conversion_key", "property_id", "status", "travel_purpose",
    "country_code", "region", "currency", "check_in_date", "check_out_date",
    "site_key", "device", "referral_property_id", "revenue", "revenue_usd",
]

REVENUE_LEAF = "commission.estimate_commission_amount.booker_currency"


def map_status(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds ``_mapped_status``: the lookup's status, else the raw code."""
    lk = unique_keys(lookup, "raw_status").select(
        F.col("raw_status").alias("_status_raw"), F.col("mapped_status").alias("_status_mapped")
    )
    joined = df.join(lk, df["status"] == lk["_status_raw"], "left")
    return joined.withColumn(
        "_mapped_status", F.coalesce(F.col("_status_mapped"), df["status"])
    ).drop("_status_raw", "_status_mapped")


def map_region(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds ``_country_code`` (upper-cased) and ``_region`` (null when unmapped)."""
    with_code = df.withColumn("_country_code", F.upper(F.col("booker.address.country")))
    lk = unique_keys(lookup, "country_code").select(
        F.col("country_code").alias("_region_code"), F.col("region").alias("_region")
    )
    return with_code.join(
        lk, with_code["_country_code"] == lk["_region_code"], "left"
    ).drop("_region_code")


def parse_label(df: DataFrame) -> DataFrame:
    """Adds ``_site_key``, ``_device`` and ``_referral_property_id`` from ``label``."""
    label = F.col("label")
    return df.withColumns({
        "_site_key": C.site_key(label),
        "_device": C.device(label),
        "_referral_property_id": C.referral_property_id(label),
    })


def select_final_columns(df: DataFrame) -> DataFrame:
    """Flatten the nested leaves and name the 14 stored columns."""
    return df.select(
        F.col("accommodations.reservation").alias("transaction_id"),
        F.col("label").alias("conversion_key"),
        C.property_id(F.col("accommodation_details.accommodation")).alias("property_id"),
        F.col("_mapped_status").alias("status"),
        F.col("booker.travel_purpose").alias("travel_purpose"),
        F.col("_country_code").alias("country_code"),
        F.col("_region").alias("region"),
        F.col("currencies.booker").alias("currency"),
        C.stay_date(F.col("start")).alias("check_in_date"),
        C.stay_date(F.col("end")).alias("check_out_date"),
        F.col("_site_key").alias("site_key"),
        F.col("_device").alias("device"),
        F.col("_referral_property_id").alias("referral_property_id"),
        F.col(REVENUE_LEAF).alias("revenue"),
    )


def add_revenue_usd(df: DataFrame, usd_rate: float | DataFrame) -> DataFrame:
    """``revenue_usd`` = round(revenue * rate, 2). A number is the rate of every row; a
    DataFrame (currency, usd_rate) gives each row the rate of its own currency, by
    exact code. A row whose currency is null or has no rate gets null, which the value
    checks count (`quality.missing_rate_rows`); no row is dropped or doubled."""
    if not isinstance(usd_rate, DataFrame):
        return df.withColumn("revenue_usd", C.usd_amount(F.col("revenue"), usd_rate))
    rates = unique_keys(usd_rate, "currency").select(
        F.col("currency").alias("_rate_currency"), F.col("usd_rate").alias("_usd_rate")
    )
    joined = df.join(rates, df["currency"] == rates["_rate_currency"], "left")
    return joined.withColumn("revenue_usd", C.usd_amount(F.col("revenue"), F.col("_usd_rate"))).drop(
        "_rate_currency", "_usd_rate"
    )


def transform(raw: DataFrame, usd_rate: float | DataFrame, status_lookup: DataFrame,
              region_lookup: DataFrame) -> DataFrame:
    """Status, region, label, flatten, revenue: the full chain, lazily. ``usd_rate``:
    see `add_revenue_usd`."""
    return (
        raw.transform(map_status, status_lookup)
        .transform(map_region, region_lookup)
        .transform(parse_label)
        .transform(select_final_columns)
        .transform(add_revenue_usd, usd_rate)
    )
