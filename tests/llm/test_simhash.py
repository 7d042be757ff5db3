import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayledger.llm import simhash as S
from stayledger.llm.components import components
from tests_llm_data import SMALL, Union, fold, prose


def brute_print(text, n=4):
    w = re.findall("[^\x20\x09-\x0D]+", fold(text))
    grams = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids_prints, radius=4):
    u = Union()
    ids_prints = sorted(ids_prints)
    for i, (a, x) in enumerate(ids_prints):
        for b, y in ids_prints[:i]:
            if (x ^ y).bit_count() <= radius:
                u.join(a, b)
    return {a: u.root(a) for a, _ in ids_prints}


def test_query_against_brute_force(spark, documents):
    prints = {r["doc_id"]: brute_print(r["text"]) for r in documents.collect()}
    want = classes(prints.items())
    rows = S.op6_simhash_covering(spark, SMALL).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        d: (format(f, "016x"), want[d]) for d, f in prints.items()
    }


@settings(max_examples=200, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.lists(st.integers(0, 63), max_size=4))
def test_every_pair_within_the_radius_shares_a_mask(x, flips):
    y = x
    for b in flips:
        y ^= 1 << b
    masks = [m & ((1 << 64) - 1) for m in S.covering_masks(4, list(range(64)))]
    assert len(masks) == 31 and any(x & m == y & m for m in masks)


def test_links_of_clusters_and_of_runs_over_the_limit(spark):
    rng = np.random.default_rng(3)
    prints = set()
    for _ in range(12):
        base = int(rng.integers(0, 1 << 63))
        for _ in range(60):
            y = base
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                y ^= 1 << int(b)
            prints.add(y)
    prints |= {int(x) for x in rng.integers(0, 1 << 63, 300)}
    want = classes([(i, x) for i, x in enumerate(sorted(prints))])
    number = {x: i for i, x in enumerate(sorted(prints))}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fingerprint long").repartition(3)
    for limit in (8192, 8):
        links = S.fingerprint_links(df, 4, run_limit=limit).collect()
        u = Union()
        for a, b in links:
            a, b = a & ((1 << 64) - 1), b & ((1 << 64) - 1)
            assert (a ^ b).bit_count() <= 64
            u.join(number[a], number[b])
        assert {i: u.root(i) for i in want} == want


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
                                   [(3, 1), (1, 3), (7, 9), (9, 8), (2, 8), (None, 4), (5, 5)]])
def test_components(spark, edges):
    u = Union()
    for a, b in edges:
        if a is not None and a != b:
            u.join(a, b)
    want = {x: u.root(x) for x in list(u.up)}
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert sorted((r["node"], r["root"]) for r in got) == sorted(want.items())


def test_one_document_of_each_class_stays(spark, edge):
    kept = S.keep_one(edge)
    assert kept.columns == edge.columns and kept.select("doc").distinct().first()[0] == "mine"
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept.collect())
    assert [x for _, x, _ in ids] == [-9, 1, 4, 5, 6, 7, 0]  # 0: the null id with text of its own
    assert ids[-1][2] == prose(2, 60)


def test_edges(edge, empty):
    out = S.near_duplicates(edge)
    rows = out.collect()
    assert len(rows) == edge.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert by[1] == by[2] == by[3] == {(0, 1)} and (0, 1) in by[None]
    assert by[4] == by[8] and {c for _, c in by[4]} == {4} and {c for _, c in by[-9]} == {-9}
    assert any(c is None for _, c in by[None])  # a class of null ids only
    assert S.near_duplicates(empty).count() == 0 and S.keep_one(empty).count() == 0
    assert out.where(F.col("doc_id") == 5).first()["fingerprint"] != 0
