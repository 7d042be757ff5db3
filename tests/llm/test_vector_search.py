import math

import numpy as np
from pyspark.sql import functions as F

from stayledger.llm import vector_search as V
from tests_llm_data import SMALL


def brute(rows, queries, k=5):
    """rows: (id, vector) pairs that take part, without repeats."""
    out = {}
    for q, x in queries:
        near = []
        for i, y in rows:
            if i != q and len(x) == len(y):
                a, b = np.array(x, np.float64), np.array(y, np.float64)
                near.append((-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i))
        out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def test_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    got = {}
    for r in V.op5_permutation_index(spark, SMALL).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(want)
    hits = 0
    vectors = dict(rows)
    for q, near in got.items():
        assert sorted(near) == [1, 2, 3, 4, 5]
        scores = [near[i][1] for i in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        for v, s in near.values():
            a, b = np.array(vectors[q], np.float64), np.array(vectors[v], np.float64)
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
        hits += len({v for v, _ in near.values()} & {v for v, _ in want[q]})
    assert hits >= 0.9 * 5 * len(want)


def test_recall_where_few_are_reranked(spark, monkeypatch):
    """10,000 vectors without clusters, the hardest case: at most a tenth is reranked, and the answer is
    the same for any partitioning and any size of blocks."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(10_000, 32))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>").cache()
    answers = []
    for n, block, queries in ((1, 10_000, 4096), (8, 100, 7), (64, 10_000, 4096)):
        monkeypatch.setattr(V, "BLOCK", block)
        monkeypatch.setattr(V, "QUERY_BLOCK", queries)
        got = {}
        for r in V.nearest_vectors(df.repartition(n), F.col("vec_id") % 100 == 0).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        answers.append({q: sorted(v) for q, v in got.items()})
    assert answers[0] == answers[1] == answers[2]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 10_000, 100):
        s = u @ u[q]
        s[q] = -2
        hits += len(set(np.argsort(-s)[:5].tolist()) & {v for _, v, _ in answers[0][q]})
    print("recall", hits / 500)
    assert hits >= 0.9 * 500
    # within the bounds of the histogram
    index, _ = V.build_index(df, "vec_id", "embedding", 5)
    index = V.cut(index)
    ranks = np.stack([np.frombuffer(r["ranks"], np.uint8) for r in index.orderBy(F.col("ids")[0]).collect()]).astype(np.int16)
    for q in range(0, 10_000, 1000):
        near = ((ranks < V.POST) & (ranks[q] < V.PROBE)).any(1)
        step = np.sort(np.abs(ranks[near] - ranks[q]).sum(1) // V.STEP)
        assert (step <= step[math.ceil(V.SHARE * 10_000) - 1]).sum() < 1000


def test_extreme_components_have_a_finite_score(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [3e-300, 3e-300]), (3, [-1e308, 1.0]), (4, [1.0, 2.0]), (5, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["score"] for r in V.nearest_vectors(df, F.col("vec_id") == 0).collect()}
    want = {1: 0.5**0.5, 2: 1.0, 3: -(0.5**0.5), 4: 3 / 10**0.5, 5: 0.5**0.5}
    assert set(got) == set(want) and all(abs(got[i] - w) < 1e-12 for i, w in want.items())


def test_a_query_whose_files_are_empty_looks_through_all(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(600, 8)) + 6, rng.normal(size=(3, 8)) - 6])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in V.nearest_vectors(df, F.col("vec_id") >= 600, post=1, probe=1, least=20, share=0.01).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == {600, 601, 602} and all(len(v) == 5 for v in got.values())


def test_ties_repeats_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(40)]  # one very common vector
    rows += [(0, [1.0, 0.0])]  # a repeated row
    rows += [(100, [0.0, 2.0]), (101, [1.0, 1.0]), (102, [-1.0, 0.0])]
    usable = sorted(set((i, tuple(v)) for i, v in rows))
    rows += [(200, None), (201, [0.0, 0.0]), (202, [nan, 1.0]), (203, [inf, 1.0]), (204, [None, 1.0]), (205, []),
             (206, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    queries = [r for r in usable if r[0] in (0, 7, 50, 100)]
    want = brute(usable, queries)
    got = {}
    for r in V.nearest_vectors(df, F.col("vec_id").isin(0, 7, 100, 200, 201, 202, 203, 204, 205, 206)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    for q, near in want.items():
        assert [v for _, v, _ in sorted(got[q])] == [v for v, _ in near]
        assert np.allclose([s for _, _, s in sorted(got[q])], [s for _, s in near], atol=1e-15)


def test_fewer_candidates_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.5, 0.5])], schema)
    got = V.nearest_vectors(two, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 50), (50, 1, 0)]
    assert V.nearest_vectors(two.limit(1), F.col("vec_id") % 50 == 0).count() == 0
    assert V.nearest_vectors(two.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert V.nearest_vectors(two, F.col("vec_id") == 7).count() == 0
    none = spark.createDataFrame([(0, None)], schema)
    assert V.nearest_vectors(none, F.col("vec_id") == 0).count() == 0
