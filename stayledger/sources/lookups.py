"""Code lookups (status, region) and currency rates as small two-column DataFrames.

A lookup's key is unique: a repeated key would double the rows it is joined to.
Lookups built from a dict are unique by construction; a file is checked when it
is loaded, any other DataFrame within the join (``unique_keys``). Joins carry no
hint: the planner broadcasts a lookup by its size. The status table ships with
the package; the region table (about 250 country codes) is a parameter: pass
a dict, or the path of a JSON object file ``{"<code>": "<region>", ...}``. Rates
(dollars for one unit of a currency) are a parameter too, in the same forms.
"""

from __future__ import annotations

import json
import math
import weakref
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import JOB_ERRORS, DataExtractionError

# Raw booking status code -> reported status, as the original
# job maps them. Matching is exact (case-sensitive, no trimming).
STATUS_MAPPING: dict[str, str] = {
    "cancelled_by_hotel": "cancelled",
    "cancelled_by_accommodation": "cancelled",
    "cancelled_by_guest": "cancelled",
    "no_show": "cancelled",
    "stayed": "approved",
    "booked": "pending",
    "S": "approved",
    "F": "pending",
    "C": "cancelled",
    "cancelled": "cancelled",
}

# Lookups whose keys are known to be unique.
_UNIQUE: weakref.WeakSet = weakref.WeakSet()


STATUS_SCHEMA = T.StructType(
    [T.StructField("raw_status", T.StringType()), T.StructField("mapped_status", T.StringType())]
)
REGION_SCHEMA = T.StructType(
    [T.StructField("country_code", T.StringType()), T.StructField("region", T.StringType())]
)

RATE_SCHEMA = T.StructType(
    [T.StructField("currency", T.StringType()), T.StructField("usd_rate", T.DoubleType())]
)


def _unique(df: DataFrame) -> DataFrame:
    _UNIQUE.add(df)
    return df


def unique_keys(lookup: DataFrame, key: str) -> DataFrame:
    """``lookup``, failing when it is read if a key has more than one row."""
    if lookup in _UNIQUE:
        return lookup
    values = [c for c in lookup.columns if c != key]
    once = F.when(F.count(F.lit(1)) == 1, F.first(F.struct(*values))).otherwise(
        F.raise_error(F.concat(F.lit("repeated lookup key: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
    return lookup.groupBy(key).agg(once.alias("_v")).select(key, *[F.col(f"_v.{c}").alias(c) for c in values])


def _from_mapping(spark: SparkSession, mapping: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """A JVM-side table of literals (no Python rows, no Python workers), of any size."""
    key, value = schema.fieldNames()
    rows = json.dumps([{key: str(k), value: None if v is None else str(v)} for k, v in mapping.items()])
    text = T.StructType([T.StructField(c, T.StringType()) for c in (key, value)])
    table = spark.range(1).select(F.inline(F.from_json(F.lit(rows), T.ArrayType(text))))
    return _unique(table.select(*(F.col(f.name).cast(f.dataType) for f in schema)))


def status_lookup(spark: SparkSession, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """(raw_status, mapped_status); the packaged mapping unless one is given."""
    return _from_mapping(spark, STATUS_MAPPING if mapping is None else mapping, STATUS_SCHEMA)


def region_lookup(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    """(country_code, region) from a dict of upper-case country code -> region."""
    return _from_mapping(spark, mapping, REGION_SCHEMA)


def load_mapping_file(spark: SparkSession, path: str, schema: T.StructType = REGION_SCHEMA) -> DataFrame:
    """Read a JSON object file ``{"key": "value", ...}`` as a two-column lookup.

    The file is read by Spark, so any Hadoop path works. Loading checks it: a file
    that is empty, truncated, malformed or no object of scalars, and a key that is
    repeated, raise ``DataExtractionError``.
    """
    key, value = schema.fieldNames()
    entries = F.from_json("value", T.MapType(T.StringType(), T.StringType()), {"mode": "FAILFAST"})
    parsed = spark.read.text(path, wholetext=True).select(entries.alias("entries"))
    rows = parsed.select(F.explode("entries").alias(key, value))
    try:
        unread = parsed.agg(F.count(F.lit(1)), F.count_if(F.col("entries").isNull())).first()
        repeated = rows.groupBy(key).count().where("count > 1").limit(5).collect()
    except JOB_ERRORS as exc:
        raise DataExtractionError(f"lookup file {path} cannot be parsed: {exc}") from exc
    if not unread[0] or unread[1]:
        raise DataExtractionError(f"lookup file {path} holds no JSON object")
    if repeated:
        raise DataExtractionError(f"lookup file {path} repeats keys: {[r[0] for r in repeated]}")
    return _unique(rows)


def rate_lookup(spark: SparkSession, rates: Mapping[str, float]) -> DataFrame:
    """(currency, usd_rate) from a dict of currency code -> dollars for one unit.
    A rate that is not a finite number above zero raises."""
    for currency, rate in rates.items():
        if not (isinstance(rate, (int, float)) and 0 < rate < math.inf):
            raise DataExtractionError(f"rate of {currency} is {rate!r}, not a number above zero")
    return _from_mapping(spark, {c: repr(float(r)) for c, r in rates.items()}, RATE_SCHEMA)


def rate_lookup_from_file(spark: SparkSession, path: str) -> DataFrame:
    """(currency, usd_rate) from a JSON object file ``{"<currency>": <rate>, ...}``,
    checked as `load_mapping_file` does, and as `rate_lookup` does its rates."""
    rows = load_mapping_file(spark, path, T.StructType([RATE_SCHEMA["currency"], T.StructField("rate", T.StringType())]))
    rates = rows.select("currency", F.col("rate").try_cast("double").alias("usd_rate"))
    usable = F.coalesce((F.col("usd_rate") > 0) & (F.col("usd_rate") < math.inf), F.lit(False))
    bad = rates.where(~usable).limit(5).collect()
    if bad:
        raise DataExtractionError(f"rate file {path} has no number above zero for {[r.currency for r in bad]}")
    return _unique(rates)


def status_lookup_from_file(spark: SparkSession, path: str) -> DataFrame:
    return load_mapping_file(spark, path, STATUS_SCHEMA)


def region_lookup_from_file(spark: SparkSession, path: str) -> DataFrame:
    return load_mapping_file(spark, path, REGION_SCHEMA)
