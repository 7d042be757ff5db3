"""Connected components of an edge table, in Spark (alternating stars).

Edges run from a larger node u to a smaller node v. Each round keeps the
components and shortens the paths. Large star: every edge (u, v) becomes (u, the
least node v knows). Small star: of the nodes u now points to, the larger ones
point to the least, and so does u. When nothing changes, every component is a
star around its smallest node. Rounds grow with the logarithm of the longest path.

Neighbourhoods are only ever aggregated with ``min``, which combines before the
shuffle, and joined back to one row per node; no node's neighbours are gathered.
A round's tables are removed once the next one's edges are written.
The aggregates are written before they are joined: both sides of a join are plain
scans then, so that a node with a third of all edges is split over many tasks,
or the small side is broadcast by its size. A round's edges are written too."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayledger.llm.frames import spill
from stayledger.session import delete_path


EDGES_PER_FILE = 200_000


def _stamp(edges: DataFrame) -> tuple:
    """Count and order-free hash of an edge table."""
    mixed = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(mixed)).first()
    return tuple(row)


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of an edge between different nodes; ``root``
    is the smallest node of its component. Repeated edges, loops and edges with
    a null end do nothing; an empty table gives an empty one."""
    spark, paths = edges.sparkSession, []
    e = spill(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
        paths,
    )
    before = _stamp(e)
    files = 1 + before[0] // EDGES_PER_FILE  # edges never become more

    def written(df: DataFrame, name: str) -> DataFrame:
        return spill(df.repartition(files), name, paths)  # a task for each partition, few files

    for _ in range(max_rounds):
        if before[0] == 0:
            break
        known = written(e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m")), "large-star")
        large = written(e.join(known, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct(), "edges")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        for path in paths[:-1]:
            delete_path(spark, path)
        del paths[:-1]
        after = _stamp(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v"), F.col("v")).distinct()
    )
