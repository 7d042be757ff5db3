"""Structure and value checks, returned as report DataFrames.

``schema_report`` walks the schema on the driver (metadata only) and tests
non-emptiness with a lazy one-row probe. ``quality_report`` computes all four
value checks in one scan and one shuffle: rows are grouped by key with
map-side partial aggregation, so a hot key costs one row per map task.
``raise_if_*`` raise for the first failing check, in the original order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DataQualityError, SchemaValidationError
from ..functions import columns as C
from ..sources.literals import literal_rows
from .transform import REVENUE_LEAF

# The raw contract (top-level column -> type name) and the type
# the revenue leaf must have.
REQUIRED_COLUMNS = {
    "id": "string",
    "accommodations": "struct",
    "accommodation_details": "struct",
    "booker": "struct",
    "commission": "struct",
    "currencies": "struct",
    "start": "string",
    "end": "string",
    "label": "string",
    "price": "struct",
    "status": "string",
}
REVENUE_TYPE = "double"

SCHEMA_REPORT = T.StructType([
    T.StructField("check_order", T.IntegerType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("expected", T.StringType()),
    T.StructField("actual", T.StringType()),
    T.StructField("passed", T.BooleanType()),
])

QUALITY_CHECKS = ["duplicate_keys", "negative_revenue", "invalid_currency", "missing_revenue"]
#: A fifth check, for runs with a rate table: an amount whose currency has no rate.
RATE_CHECK = "missing_rate"


def _leaf_type(schema: T.StructType, path: str) -> str | None:
    """Type name of the nested field at ``path``, or None where the schema has none."""
    here: T.DataType = schema
    for name in path.split("."):
        if not isinstance(here, T.StructType) or name not in here.fieldNames():
            return None
        here = here[name].dataType
    return here.typeName()


def schema_report(df: DataFrame, inferred_from_all_lines: bool = False) -> DataFrame:
    """One row per check: non-empty, required columns, their types, revenue leaf.

    ``inferred_from_all_lines`` says the schema was inferred from every input
    line: then a schema with any field proves a row exists, and the
    emptiness probe (a read of the first split) is not needed."""
    spark = df.sparkSession
    fields = {f.name: f.dataType.typeName() for f in df.schema.fields}
    rows = []
    for name in REQUIRED_COLUMNS:
        rows.append((2, "column_present", name, "present",
                     "present" if name in fields else "missing", name in fields))
    for name, expected in REQUIRED_COLUMNS.items():
        actual = fields.get(name)
        rows.append((3, "column_type", name, expected, actual, actual == expected))
    leaf = _leaf_type(df.schema, REVENUE_LEAF)
    rows.append((4, "revenue_type", REVENUE_LEAF, REVENUE_TYPE, leaf, leaf == REVENUE_TYPE))
    if inferred_from_all_lines and fields:
        rows.insert(0, (1, "not_empty", None, "rows", "rows", True))
        return literal_rows(spark, rows, SCHEMA_REPORT)
    static = literal_rows(spark, rows, SCHEMA_REPORT)
    non_empty = (
        df.select(F.lit(1).alias("one")).limit(1)
        .agg((F.count(F.lit(1)) > 0).alias("passed"))
        .select(
            F.lit(1).alias("check_order"), F.lit("not_empty").alias("check_name"),
            F.lit(None).cast("string").alias("column_name"), F.lit("rows").alias("expected"),
            F.when(F.col("passed"), "rows").otherwise("empty").alias("actual"), "passed",
        )
    )
    return non_empty.unionByName(static)


_SCHEMA_RULES = {1: "the input has no rows", 2: "columns are absent", 3: "columns have another type",
                 4: "the revenue leaf is absent or has another type"}


def raise_if_schema_bad(report: DataFrame) -> None:
    """Raise ``SchemaValidationError`` for the first failing check, with all its
    offending columns. The report is bounded by the contract size."""
    failed = [r for r in report.collect() if not r.passed]
    if not failed:
        return
    order = min(r.check_order for r in failed)
    bad = [r for r in failed if r.check_order == order]
    found = ", ".join(f"{r.column_name} is {r.actual}, not {r.expected}" for r in bad if r.column_name)
    raise SchemaValidationError(bad[0].check_name, _SCHEMA_RULES[order] + (f" ({found})" if found else ""),
                                [r.column_name for r in bad if r.column_name], len(bad))


def validate_schema(df: DataFrame, inferred_from_all_lines: bool = False) -> None:
    raise_if_schema_bad(schema_report(df, inferred_from_all_lines))


# --- value checks -------------------------------------------------------------------

def _flags(rates: bool = False) -> dict[str, Column]:
    flags = {
        "negative_revenue": C.is_negative_revenue(F.col("revenue"), F.col("revenue_usd")),
        "invalid_currency": C.is_invalid_currency(F.col("currency")),
        "missing_revenue": C.is_missing_revenue(F.col("revenue")),
    }
    return flags | {RATE_CHECK: C.is_missing_rate(F.col("revenue"), F.col("revenue_usd"))} if rates else flags


def quality_counts(df: DataFrame, key: str = "transaction_id", rates: bool = False) -> DataFrame:
    """One row with the four bad counts (five with ``rates``), in one scan and one key
    shuffle.

    Keys with more than one row are counted once each; null keys form one group.
    """
    flags = _flags(rates)
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(cond).alias(name) for name, cond in flags.items()],
    )
    return per_key.agg(
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in flags],
    )


def quality_report(df: DataFrame, key: str = "transaction_id", rates: bool = False) -> DataFrame:
    """(check_order, check_name, bad_count) for the four checks, in order, and with
    ``rates`` for amounts without a rate."""
    counts = quality_counts(df, key, rates)
    entries = [
        F.struct(F.lit(i + 1).alias("check_order"), F.lit(name).alias("check_name"),
                 F.col(name).cast("bigint").alias("bad_count"))
        for i, name in enumerate(QUALITY_CHECKS + [RATE_CHECK] * rates)
    ]
    return counts.select(F.inline(F.array(*entries)))


_VALUE_RULES = {
    "duplicate_keys": "keys with more than one row",
    "negative_revenue": "rows with an amount below zero",
    "invalid_currency": "rows whose currency is not three capital letters",
    "missing_revenue": "rows whose revenue is null or not a number",
    RATE_CHECK: "rows with an amount whose currency has no rate",
}


def raise_if_bad(report: DataFrame) -> None:
    """Raise ``DataQualityError`` for the first check with a count above zero."""
    bad = sorted((r for r in report.collect() if r.bad_count), key=lambda r: r.check_order)
    if bad:
        first = bad[0]
        raise DataQualityError(first.check_name, f"{first.bad_count} {_VALUE_RULES[first.check_name]}",
                               count=first.bad_count)


def validate_quality(df: DataFrame, key: str = "transaction_id", rates: bool = False) -> None:
    raise_if_bad(quality_report(df, key, rates))


def duplicate_keys(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """(key, n) for every key value with more than one row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def negative_revenue_rows(df: DataFrame) -> DataFrame:
    return df.filter(C.is_negative_revenue(F.col("revenue"), F.col("revenue_usd")))


def invalid_currency_rows(df: DataFrame) -> DataFrame:
    return df.filter(C.is_invalid_currency(F.col("currency")))


def missing_revenue_rows(df: DataFrame) -> DataFrame:
    return df.filter(C.is_missing_revenue(F.col("revenue")))


def missing_rate_rows(df: DataFrame) -> DataFrame:
    return df.filter(C.is_missing_rate(F.col("revenue"), F.col("revenue_usd")))
