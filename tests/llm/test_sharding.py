import math
import zlib

import pytest
import xxhash

from stayledger.llm.sharding import number_slots, op3_rendezvous_sharding, shard_records
from tests_llm_data import SMALL


def test_query_obeys_the_law(spark, documents):
    rows = op3_rendezvous_sharding(spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def _xx(data, seed):
    return xxhash.xxh64_intdigest(data, seed=seed)


def winner(key, weights):
    """The shard with the highest bid: Spark's xxhash64 of (key as text, shard number)."""
    bids = []
    for s, w in enumerate(weights):
        seed = 42 if key is None else _xx(str(key).encode(), 42)
        h = _xx(s.to_bytes(4, "little"), seed) >> 11  # the text's hash seeds the number's
        bids.append((math.log((h + 0.5) / 2**53) / w, -s))
    return -max(bids)[1]


def test_query_gives_every_record_to_the_highest_bid(spark):
    rows = op3_rendezvous_sharding(spark, SMALL).collect()
    for r in rows:
        assert r["shard"] == winner(r["doc_id"], [1.0] * 16) and r["grown_shard"] == winner(r["doc_id"], [1.0] * 17)
    keys = spark.createDataFrame([(i,) for i in [None, -5, *range(500)]], "doc_id long")
    for r in shard_records(keys, weights=(0.5, 3.0, 1.0, 7.5), grown_weight=2.0).collect():
        assert r["shard"] == winner(r["doc_id"], [0.5, 3.0, 1.0, 7.5])
        assert r["grown_shard"] == winner(r["doc_id"], [0.5, 3.0, 1.0, 7.5, 2.0])


def test_key_decides_and_growth_takes_only_into_the_new_shard(edge, spark):
    a = {(r["doc_id"]): r["shard"] for r in shard_records(edge).collect()}
    b = {(r["doc_id"]): r["shard"] for r in shard_records(edge.limit(5)).collect()}
    assert all(a[k] == v for k, v in b.items())
    grown = shard_records(spark.range(20_000).withColumnRenamed("id", "doc_id"), grown_weight=1.0)
    moved = grown.where("shard <> grown_shard")
    assert moved.where("grown_shard <> 16").count() == 0
    assert abs(moved.count() - 20_000 / 17) < 5 * math.sqrt(20_000 / 17)


def test_weights_share_the_records(spark):
    n = 30_000
    rows = shard_records(spark.range(n).withColumnRenamed("id", "doc_id"), weights=(1.0, 2.0, 3.0))
    got = dict(rows.groupBy("shard").count().collect())
    for s, share in enumerate((1 / 6, 2 / 6, 3 / 6)):
        assert abs(got[s] - n * share) < 5 * math.sqrt(n * share)
    with pytest.raises(ValueError):
        shard_records(spark.range(1).withColumnRenamed("id", "doc_id"), weights=(1.0, 0.0))


def test_repeated_and_null_keys_get_gapless_slots_over_many_buckets(spark):
    rows = shard_records(spark.range(4000).selectExpr("case when id % 3 = 0 then null else id % 50 end as doc_id"))
    got = number_slots(rows.select("doc_id", "shard"), ["doc_id"], rows_per_bucket=20).collect()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == 4000 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edges(edge, empty):
    out = shard_records(edge, grown_weight=1.0)
    assert out.count() == edge.count() and set(edge.columns) <= set(out.columns)
    assert dict(out.dtypes)["shard"] == "int"
    assert number_slots(shard_records(empty).select("doc_id", "shard"), ["doc_id"]).count() == 0
