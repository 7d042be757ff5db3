"""Weighted rendezvous sharding of records (Spark expressions only).

Every shard bids for a record: with ``u`` a hash of (record key, shard number)
mapped into (0, 1), shard ``s`` of weight ``w`` bids ``ln(u) / w`` and the
highest bid wins. A bid depends on nothing but the key and that one shard, so
one shard more takes records only into itself (a share of w_new / sum of w),
and a changed weight moves only what that shard gains or loses. No shuffle.

Slots number the records of a shard without gaps. One shard may hold any share
of the rows, so no task sorts a whole shard: rows fall into buckets of about
``rows_per_bucket``, buckets are counted, and a running sum over the counts
(one row per bucket) gives each bucket its first slot.

Defined results: a null key is hashed as a key of its own; rows that repeat a
key share its shard and get different slots; a null text has size 1 and the checksum of no bytes (0); an empty
table stays empty. Columns of the input are kept; those named like an output
are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stayledger.llm.frames import cut, table

_TOP = 1 << 53


def _bid(key: Column, shard: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return F.log((bits + 0.5) / float(_TOP)) / F.lit(float(weight))


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that wins ``key``; ties go to the smaller number."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights: one positive number for each shard")
    bids = [F.struct(_bid(key, s, w).alias("bid"), F.lit(-s).alias("neg")) for s, w in enumerate(weights)]
    return (-F.array_max(F.array(*bids))["neg"]).cast("int")


def shard_records(
    docs: DataFrame,
    key: str = "doc_id",
    weights: Sequence[float] = (1.0,) * 16,
    grown_weight: float | None = None,
) -> DataFrame:
    """Adds ``shard`` and, for ``grown_weight``, ``grown_shard``: the shard with
    one more of that weight. Every shard's bid is computed from the key as text."""
    k = F.col(key).cast("string")
    out = docs.withColumn("shard", rendezvous_shard(k, weights))
    if grown_weight is not None:
        out = out.withColumn("grown_shard", rendezvous_shard(k, [*weights, grown_weight]))
    return out


def number_slots(rows: DataFrame, order: Sequence[str], rows_per_bucket: int = 20_000) -> DataFrame:
    """Adds ``slot``, 0 to n-1 within each ``shard``, by (bucket, ``order``).

    ``rows`` should be narrow: it is checkpointed, as it is read twice. Rows
    that repeat all of ``order`` still spread over buckets, by input partition."""
    rows = cut(rows.withColumn("__part", F.spark_partition_id()))
    # a shard of a third of all rows has that many buckets too: the count is of all rows
    n = max(1, math.ceil(rows.count() / rows_per_bucket / 16))
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order, "__part"), F.lit(n)).cast("int"))
    first = (
        rows.groupBy("shard", "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__first", F.sum("__n").over(Window.partitionBy("shard").orderBy("__bucket")) - F.col("__n"))
        .drop("__n")
    )
    in_bucket = F.row_number().over(Window.partitionBy("shard", "__bucket").orderBy(*order))
    return (
        rows.withColumn("__at", in_bucket)
        .join(first, ["shard", "__bucket"])
        .withColumn("slot", (F.col("__first") + F.col("__at") - 1).cast("long"))
        .drop("__bucket", "__part", "__at", "__first")
    )


def op3_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    sharded = shard_records(narrow, grown_weight=1.0)
    slots = number_slots(sharded, ["doc_id", "size", "text_crc32"])
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
