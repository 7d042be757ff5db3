"""Read-back of the table (S4): schema and ordered samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import table as TB
from ..sources.literals import literal_rows

DESCRIBE_SCHEMA = T.StructType([T.StructField("col_name", T.StringType()),
                                T.StructField("data_type", T.StringType())])

# The columns of the short sample.
SAMPLE_COLUMNS = ["transaction_id", "conversion_key", "revenue", "currency", "status", "check_in_date"]


def describe(spark: SparkSession, spec: TB.TableSpec) -> DataFrame:
    """(col_name, data_type) of the stored columns, in order."""
    fields = TB.read_table(spark, spec).schema.fields
    return literal_rows(spark, [(f.name, f.dataType.simpleString()) for f in fields], DESCRIBE_SCHEMA)


def sample(spark: SparkSession, spec: TB.TableSpec, n: int = 20,
           columns: list[str] | None = None) -> DataFrame:
    """First ``n`` rows by key: a top-n (TakeOrderedAndProject), not a sort."""
    df = TB.read_table(spark, spec)
    if columns:
        df = df.select(*columns)
    return df.orderBy(spec.key).limit(n)
