"""Scalar column rules of the booking table (JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "LABEL_SITE_PATTERN", "LABEL_DEVICE_PATTERN", "LABEL_REFERRAL_PATTERN",
    "DEVICE_NAMES", "CURRENCY_PATTERN", "PROPERTY_PREFIX",
    "site_key", "device_code", "device", "referral_property_id", "property_id",
    "stay_date", "usd_amount", "is_negative_revenue", "is_invalid_currency",
    "is_missing_revenue", "is_missing_rate",
]

# Label patterns (unanchored, first match wins; no match -> ''),
# device code names, the currency code pattern and the property id prefix.
LABEL_SITE_PATTERN = r"k-([a-zA-Z]+)"
LABEL_DEVICE_PATTERN = r"d-([a-zA-Z]+)"
LABEL_REFERRAL_PATTERN = r"p-(BC-\d+)"
DEVICE_NAMES = {"m": "mobile", "d": "desktop", "t": "tablet"}
CURRENCY_PATTERN = r"^[A-Z]{3}$"
PROPERTY_PREFIX = "BC-"


def site_key(label: Column) -> Column:
    return F.upper(F.regexp_extract(label, LABEL_SITE_PATTERN, 1))


def device_code(label: Column) -> Column:
    return F.regexp_extract(label, LABEL_DEVICE_PATTERN, 1)


def device(label: Column) -> Column:
    """Device name for m/d/t (exact case); any other code is passed through."""
    code = device_code(label)
    out = None
    for short, name in DEVICE_NAMES.items():
        out = (F.when if out is None else out.when)(code == short, F.lit(name))
    return out.otherwise(code)


def referral_property_id(label: Column) -> Column:
    return F.regexp_extract(label, LABEL_REFERRAL_PATTERN, 1)


def property_id(accommodation: Column) -> Column:
    """'BC-' || accommodation; null-strict like SQL concat."""
    return F.concat(F.lit(PROPERTY_PREFIX), accommodation.cast("string"))


def stay_date(text: Column) -> Column:
    """Date of a date-like string; null when it cannot be parsed.

    ``try_cast`` keeps the lenient pre-ANSI behaviour of ``to_date`` without
    format: '2024' and '2024-3' give the first day of the period, blanks are
    trimmed, a time and offset after the day are ignored, bad text -> null.
    """
    return text.try_cast("date")


def usd_amount(revenue: Column, rate: float | Column) -> Column:
    """round(revenue * rate, 2), HALF_UP like Spark's round."""
    r = rate if isinstance(rate, Column) else F.lit(float(rate))
    return F.round(revenue * r, 2)


def is_negative_revenue(revenue: Column, revenue_usd: Column) -> Column:
    return (revenue < 0) | (revenue_usd < 0)


def is_invalid_currency(currency: Column) -> Column:
    """True for a value that is not a 3-letter upper-case code; null stays null."""
    return ~currency.rlike(CURRENCY_PATTERN)


def is_missing_revenue(revenue: Column) -> Column:
    return revenue.isNull() | F.isnan(revenue)


def is_missing_rate(revenue: Column, revenue_usd: Column) -> Column:
    """True where there is an amount, but no rate turned it into dollars."""
    return revenue.isNotNull() & revenue_usd.isNull()
