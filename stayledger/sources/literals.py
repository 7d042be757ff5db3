"""Small tables of literal rows (reports, empty results), built JVM-side.

``createDataFrame`` of a Python list becomes a Python RDD that starts Python
workers when it is read; these rows travel as one JSON literal parsed with
``from_json`` instead, so reading them is a plain JVM scan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Sequence[Sequence | dict], schema: T.StructType) -> DataFrame:
    """A DataFrame of ``rows`` (tuples in schema order, or dicts) with ``schema``."""
    names = schema.fieldNames()
    docs = [r if isinstance(r, dict) else dict(zip(names, r)) for r in rows]
    parsed = F.from_json(F.lit(json.dumps(docs, default=str)), T.ArrayType(schema))
    return spark.range(1).select(F.inline(parsed)).select(
        *[F.col(f.name).cast(f.dataType) for f in schema.fields])


def empty_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame with ``schema``."""
    return literal_rows(spark, [], schema)
