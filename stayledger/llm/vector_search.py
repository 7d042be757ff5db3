"""Approximate nearest neighbours by a permutation index.

``PIVOTS`` vectors (a bounded sample: those with the smallest hashes) stand for
the space. A vector is represented by its permutation, the order of the pivots
by nearness, stored as one byte of rank per pivot. Every vector is posted in the
inverted files of its ``post`` nearest pivots; a query looks through the files of its
``probe`` nearest pivots, ranks what it finds by footrule distance (the sum of rank
differences) and computes the cosine of the best ``share`` of the index, ``least`` at
least (all that lie as near as the last of them, in steps of ``STEP``).

Files and queries meet by pivot: a file is cut into blocks of about ``BLOCK`` vectors, its
queries into blocks of about ``QUERY_BLOCK``, and each pair of blocks is one group of a
shuffle, so that a pivot that very many vectors are near to spreads over many tasks. What
stands in several files of a query counts in the nearest to the query alone. The
groups are taken twice: first every query's footrule distances are counted in a
histogram, which gives its bound over the whole index; then what lies within the bound is
reranked, and a group answers with its k + 1 best. The result does not depend on how
the rows are partitioned. Queries with fewer than k answers look through all files.

Equal vectors are indexed once, with their k + 1 smallest ids: more cannot be
among anyone's k nearest, as ties go to smaller ids. So neither a vector that a
third of the rows share nor its queries cost more than one vector does. Nothing is
broadcast but the pivots.

Defined results: vectors that are null, zero, hold null or non-finite places, or
differ in length from the pivots' (the commonest length) take no part, nor do
rows without an id; rows that repeat id and vector count once; a query's own id
is never its neighbour; fewer than k others give all of them; an empty table
gives no rows; other columns of the input are not read. Very long vectors and very
large or small components are fine: cosines are computed on vectors scaled by a
power of two. Work is (queries) x (vectors in their files), for all of whom ranks are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stayledger.llm.frames import cut, spill, table

PIVOTS = 256  # ranks fit one byte
POST, PROBE, SHARE, LEAST = 4, 64, 0.05, 100
STEP = 64  # of footrule distances
BLOCK, QUERY_BLOCK = 10_000, 4096


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows with their largest component brought to about one, exactly."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)


def _ranks(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rank (0: nearest) of every pivot for every row; ties to the smaller pivot number."""
    order = np.argsort(-(units @ pivots.T), axis=1, kind="stable")
    ranks = np.empty(order.shape, np.uint8)
    np.put_along_axis(ranks, order, np.arange(order.shape[1], dtype=np.uint8)[None, :], 1)
    return ranks


def build_index(
    vectors: DataFrame, vec_id: str, vector: str, k: int, pivots: int = PIVOTS
) -> tuple[DataFrame, np.ndarray]:
    """The index table (vector, ids: its k + 1 smallest, k1 and k2: its hash, ranks)
    and the pivots as unit vectors."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector")).where(
        F.col("id").isNotNull() & usable(F.col("vector"))
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return None, np.zeros((0, 0))
    rows = rows.where(F.size("vector") == lengths["n"])
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    ids = rows.distinct().withColumn("at", first).where(F.col("at") <= k + 1)
    classes = ids.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = cut(
        classes.withColumn("k1", F.xxhash64("vector")).withColumn("k2", F.xxhash64("vector", F.lit(1)))
    )
    chosen = classes.orderBy("k1", "k2").select("vector").limit(pivots).collect()
    centers = _units(np.array([r["vector"] for r in chosen], np.float64))
    shared = vectors.sparkSession.sparkContext.broadcast(centers)

    @F.arrow_udf("binary")
    def permutation(column: pa.Array) -> pa.Array:
        ranks = _ranks(_units(_matrix(column)), shared.value)
        return pa.array([r.tobytes() for r in ranks], pa.binary())

    return classes.withColumn("ranks", permutation("vector")), centers


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, pa.Table]]:
    """Rows sorted by (pivot, i, j, kind): the pivot, vectors (kind 0) and queries (kind 1)
    of each group that has both."""
    held: list[pa.RecordBatch] = []

    def whole():
        rows = pa.Table.from_batches(held)
        kind = rows.column("kind").to_numpy()
        n = int((kind == 0).sum())
        if 0 < n < len(kind):
            yield rows.column("pivot")[0].as_py(), rows.slice(0, n).combine_chunks(), rows.slice(n).combine_chunks()

    for batch in batches:
        own = np.stack([batch.column(c).to_numpy() for c in ("pivot", "i", "j")])
        edges = np.flatnonzero((own[:, 1:] != own[:, :-1]).any(0)) + 1
        for first, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            part = batch.slice(first, end - first)
            if held and any(held[0].column(c)[0] != part.column(c)[0] for c in ("pivot", "i", "j")):
                yield from whole()
                held = []
            held.append(part)
    if held:
        yield from whole()


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _footrule(batches: Iterator[pa.RecordBatch], post: int):
    """For every group its vectors and queries, and for each query (its number, the
    vectors that count here, their footrule distances)."""
    for pivot, vectors, queries in _groups(batches):
        own, asked = _bytes(vectors.column("ranks")), _bytes(queries.column("ranks"))
        posted = np.argpartition(own, min(post, own.shape[1]) - 1, axis=1)[:, :post]

        def near(own=own, asked=asked, posted=posted, pivot=pivot):
            for q, ranks in enumerate(asked):
                at = np.flatnonzero(ranks[posted].min(1) == ranks[pivot])  # no file nearer to the query has them
                x = own[at]
                yield q, at, (np.maximum(x, ranks) - np.minimum(x, ranks)).sum(1, dtype=np.int32)

        yield vectors, queries, near()


def _counted(batches: Iterator[pa.RecordBatch], post: int) -> Iterator[pa.RecordBatch]:
    """(k1, k2, step, n): how many vectors lie in each step of footrule distance."""
    for _, queries, near in _footrule(batches, post):
        rows = [(q, *np.unique(far // STEP, return_counts=True)) for q, _, far in near]
        of = np.repeat([q for q, *_ in rows], [len(s) for _, s, _ in rows]).astype(np.int64)
        names = ["k1", "k2", "step", "n"]
        columns = [queries.column(c).combine_chunks().take(pa.array(of)) for c in names[:2]]
        columns += [pa.array(np.concatenate([r[i] for r in rows]).astype(np.int64)) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _answer(batches: Iterator[pa.RecordBatch], k: int, post: int) -> Iterator[pa.RecordBatch]:
    """(k1, k2, id, score): of each group every query's k + 1 best within its bound."""
    for vectors, queries, near in _footrule(batches, post):
        x, asked = (_scaled(_matrix(t.column("vector").combine_chunks())) for t in (vectors, queries))
        norms, asked_norms = (np.sqrt((y * y).sum(1)) for y in (x, asked))
        bounds, ids = queries.column("bound").to_numpy(), vectors.column("ids").to_pylist()
        out: dict[str, list] = {"q": [], "id": [], "score": []}
        for q, at, far in near:
            at = at[far // STEP <= bounds[q]]
            score = (x[at] * asked[q]).sum(1) / (norms[at] * asked_norms[q])
            if len(at) > k + 1:
                edge = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                at, score = at[score >= edge], score[score >= edge]  # ties at the edge stay
            for i, s in zip(at.tolist(), score.tolist()):
                out["q"] += [q] * len(ids[i])
                out["id"] += ids[i]
                out["score"] += [s] * len(ids[i])
        of = pa.array(out["q"], pa.int64())
        kind = vectors.schema.field("ids").type.value_type
        columns = [*(queries.column(c).combine_chunks().take(of) for c in ("k1", "k2")), pa.array(out["id"], kind), pa.array(out["score"], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "id", "score"])


def _files(ranks: Column, n: int) -> Column:
    """The pivots of the ``n`` least ranks of a permutation, one a row."""

    @F.arrow_udf("array<int>")
    def nearest(column: pa.Array) -> pa.Array:
        return pa.array([np.flatnonzero(np.frombuffer(r, np.uint8) < n) for r in column.to_pylist()], pa.list_(pa.int32()))

    return F.explode(nearest(ranks))


def _search(index: DataFrame, keys: DataFrame, k: int, post: int, probe: int, share: float, least: int) -> DataFrame:
    """(k1, k2, near): the k + 1 nearest found, as (at, id, score), for each key."""
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    files = index.withColumn("pivot", _files(F.col("ranks"), post))
    asked = keys.withColumn("pivot", _files(F.col("ranks"), probe))

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:  # a row a pivot
        return rows.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / size).alias(name))

    sizes = spill(blocks(files, BLOCK, "n_i").join(blocks(asked, QUERY_BLOCK, "n_j"), "pivot"), "pivot-files")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("k2"), F.col(n))
    columns = ["pivot", "i", "j", "kind", "k1", "k2", "vector", "ids", "ranks", "bound"]
    none = F.lit(None).cast("long")
    posted = files.join(F.broadcast(sizes), "pivot").withColumn("i", own("n_i")).withColumn("j", every("n_j"))
    posted = posted.withColumn("kind", F.lit(0)).withColumn("bound", none).select(*columns)

    def grouped(asked: DataFrame) -> DataFrame:
        rows = asked.join(F.broadcast(sizes), "pivot").withColumn("i", every("n_i")).withColumn("j", own("n_j"))
        rows = rows.withColumn("kind", F.lit(1)).withColumn("ids", F.lit(None).cast(index.schema["ids"].dataType)).select(*columns)
        return posted.union(rows).repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "kind", "k1", "k2")

    counts = grouped(asked.withColumn("bound", none)).mapInArrow(lambda it: _counted(it, post), "k1 long, k2 long, step long, n long")
    counts = counts.groupBy("k1", "k2", "step").agg(F.sum("n").alias("n"))
    enough = max(least, math.ceil(share * index.count()))
    upto = F.sum("n").over(Window.partitionBy("k1", "k2").orderBy("step"))
    bounds = counts.withColumn("before", upto - F.col("n")).where(F.col("before") < enough)
    bounds = spill(bounds.groupBy("k1", "k2").agg(F.max("step").alias("bound")), "query-bounds")
    found = grouped(asked.join(bounds, ["k1", "k2"])).mapInArrow(
        lambda it: _answer(it, k, post), f"k1 long, k2 long, id {id_type}, score double"
    )
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "id")
    best = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    lists = best.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("at", "id", "score"))).alias("near"))
    return spill(lists, "nearest")  # a vector that many queries share is then split, or the lists broadcast


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    pivots: int = PIVOTS,
    post: int = POST,
    probe: int = PROBE,
    share: float = SHARE,
    least: int = LEAST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row with ``is_query``, its ``k``
    nearest other rows found, by cosine."""
    spark, id_type = vectors.sparkSession, vectors.schema[vec_id].dataType
    index, centers = build_index(vectors, vec_id, vector, k, pivots)
    schema = f"query_id {id_type.simpleString()}, rank int, vec_id {id_type.simpleString()}, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    index = cut(index.repartition("k1"))
    askers = (
        vectors.where(is_query)
        .select(F.col(vec_id).alias("query_id"), F.col(vector).alias("vector"))
        .where(F.col("query_id").isNotNull() & usable(F.col("vector")) & (F.size("vector") == centers.shape[1]))
        .distinct()
        .select("query_id", F.xxhash64("vector").alias("k1"), F.xxhash64("vector", F.lit(1)).alias("k2"))
    )
    wanted = askers.select("k1", "k2").distinct()
    keys = cut(wanted.join(index.select("k1", "k2", "vector", "ranks"), ["k1", "k2"]))
    if keys.isEmpty():
        return spark.createDataFrame([], schema)
    lists = _search(index, keys, k, post, probe, share, least)
    full = lists.where(F.size("near") > k)
    short = keys.join(full, ["k1", "k2"], "left_anti")
    if probe < len(centers) and not short.isEmpty():
        lists = full.union(_search(index, cut(short), k, post, len(centers), share, least))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (
        askers.join(lists, ["k1", "k2"])
        .select("query_id", F.posexplode(others).alias("at", "x"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
    )


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_vectors(vectors, F.col("vec_id") % 50 == 0)
