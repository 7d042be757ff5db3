"""Split an input into n batches by key (R1, F1).

A batch id is a pure function of the key, so a slice is a filter that needs
no shuffle and is the same on every evaluation (no reliance on a repeatable
round-robin). Rows with one key always share a batch. The default is
``pmod(xxhash64(key), n)``, near-equal for any key set; ``modulo`` takes
``pmod(key, n)`` of an integral key, which other SQL engines can follow. A null
key is a key like any other (batch 0 with ``modulo``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "_batch"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def batch_id(df: DataFrame, key: str, n: int, method: str = "hash") -> Column:
    if n < 1:
        raise ValueError("n must be at least 1")
    if method == "modulo":
        if not isinstance(df.schema[key].dataType, _INTEGRAL):
            raise ValueError("modulo needs an integral key")
        return F.pmod(F.coalesce(F.col(key).cast("bigint"), F.lit(0)), F.lit(n)).cast("int")
    if method == "hash":
        return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")
    raise ValueError("method must be 'modulo' or 'hash'")


def with_batch_id(df: DataFrame, key: str, n: int, method: str = "hash") -> DataFrame:
    return df.withColumn(BATCH, batch_id(df, key, n, method))


def batch_slice(df: DataFrame, key: str, i: int, n: int, method: str = "hash") -> DataFrame:
    """Rows of batch ``i`` (0-based) out of ``n``."""
    return df.where(batch_id(df, key, n, method) == i)


def stage_batches(df: DataFrame, key: str, n: int, path: str, method: str = "hash") -> DataFrame:
    """Evaluate ``df`` once into Parquet partitioned by batch id; each later
    slice (``where(_batch == i)``) is a partition-pruned read of 1/n of it."""
    with_batch_id(df, key, n, method).write.mode("overwrite").partitionBy(BATCH).parquet(path)
    return df.sparkSession.read.schema(
        T.StructType(df.schema.fields + [T.StructField(BATCH, T.IntegerType())])
    ).parquet(path)
