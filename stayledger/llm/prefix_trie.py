"""The trie of conversation prefixes, with subtree totals by time-forward processing.

A node is a different sequence of first turns (role, text); its members are the
conversations that start with it, and it is known as (smallest member, depth). For
each node: members, children, leaves below, and the code points that storing shared
turns once would save in its subtree.

1. Turns are numbered by a range sort of narrow rows (hashes of the turns, no
   texts), so that a conversation with a third of all rows spreads over many tasks.
2. A prefix is known by 128 bits: the exclusive or of its turns' hashes, each mixed
   with its place. That is a running sum, taken within bands of ``band`` turns, to which
   the bands before are added. Nodes are counted by one aggregate over these.
3. Fragments. Nodes are *crowded* with more than the root of all rows as members
   (at most as many as that root, as members sum to the rows: their broadcast is
   bounded), else *sparse*. A fragment is a connected part of the trie within one
   band: the crowded nodes under a node at the band's start, or a topmost sparse node
   with all below it. Both have at most (root of all rows) x ``band`` nodes.
4. Time-forward processing. A shard sorts its fragments' nodes by reverse level order
   (Spark's external sort) and sweeps them once: a node takes the messages of its
   children from a priority queue, which spills sorted runs, and sends its totals to
   its parent. Totals of fragments without fragments below them are plain sums,
   combined by the node they hang from; the other fragments' roots, few, are swept
   across shards; then every shard sweeps with the messages of the fragments below.
5. The conversations that end at a node are sorted by range, joined to stretches of
   decimal text in many tasks, and the stretches streamed through one SHA-256 a node.

The queue's runs are unnamed files in the folder Spark gives a task to spill to; no
other process reads them and they go with the task.

Defined results: rows without a conversation id belong to none and are left out; null
turn numbers come first; rows of one turn number stand in the order of role, then of
a hash of the text, and repeated rows are turns each; null roles and texts are empty;
an empty table has no nodes, not even a root; other columns are not carried. Work on
a very long text is one hash; a conversation of n turns adds at most n nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stayledger.llm.frames import spill, table

BAND = 4096
QUEUE_LIMIT = 1 << 18  # messages in memory
_IDS = 4096  # ids joined to one stretch
_RUN = 1024  # messages written at a time

#: Rebuilding: a conversation takes up to ``MOST_HEAD`` turns of the first of its ``FAMILY``.
FAMILY, MOST_HEAD = 100, 5


def number_turns(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, pos from 1, t1, t2, chars): the turns in order, as hashes."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    order = [F.col("turn").asc_nulls_first(), "role", "t1", "t2"]
    narrow = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        who.alias("role"),
        F.xxhash64(F.lit(1), who, said).alias("t1"),
        F.xxhash64(F.lit(2), who, said).alias("t2"),
        F.char_length(said).cast("long").alias("chars"),
    )
    placed = spill(narrow.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns-by-range")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))  # one row a conversation and range
    starts = starts.select("conv", "part", F.sum("n").over(before).alias("start")).where("start > 0")
    within = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    numbered = placed.withColumn("pos", within).join(starts, ["conv", "part"], "left")
    return numbered.select("conv", (F.col("pos") + F.coalesce("start", F.lit(0))).alias("pos"), "t1", "t2", "chars")


def turns_as_they_are(numbered: DataFrame, band: int = BAND) -> DataFrame:
    """(conv, depth, t1, t2, chars, length) for `prefix_trie`, with a root row each."""
    sizes = numbered.groupBy("conv").agg(F.max("pos").alias("length"))
    return _roots(sizes).union(_own_turns(numbered, sizes.withColumn("shift", F.lit(0)), band))


def _roots(sizes: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return sizes.select("conv", *(zero.alias(c) for c in ("depth", "t1", "t2", "chars")), F.col("length").cast("long"))


def _own_turns(numbered: DataFrame, sizes: DataFrame, band: int) -> DataFrame:
    """The turns at ``pos + shift``; a conversation's row is there once for each of its bands."""
    bands = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - shift) div {band}"))).alias("band")
    by_band = sizes.select("conv", "shift", "length", bands)
    own = numbered.withColumn("band", F.expr(f"cast(pos as long) div {band}")).join(by_band, ["conv", "band"])
    return own.select(
        "conv", (F.col("pos") + F.col("shift")).cast("long").alias("depth"), "t1", "t2", "chars", F.col("length").cast("long")
    )


def rebuilt_turns(numbered: DataFrame, family: int = FAMILY, most_head: int = MOST_HEAD, band: int = BAND) -> DataFrame:
    """As `turns_as_they_are`, of conversations whose first h turns are those of the
    first of their family (conv - conv % family), h = crc32 of the decimal id modulo
    ``most_head + 1``; their own turns after the first h follow."""
    conv = F.col("conv")
    sizes = numbered.groupBy("conv").agg(F.max("pos").cast("long").alias("n"))
    sizes = sizes.select("conv", "n", (conv - conv % family).alias("first"), (F.crc32(conv.cast("string").cast("binary")) % (most_head + 1)).alias("h"))
    firsts = sizes.where(conv % family == 0).select(conv.alias("first"), F.col("n").alias("first_n"))
    head = F.least("h", F.coalesce("first_n", F.lit(0)))
    sizes = sizes.join(firsts, "first", "left").select("conv", "first", "n", "h", head.alias("head"))
    sizes = spill(sizes.withColumn("length", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt-sizes")
    heads = numbered.where((conv % family == 0) & (F.col("pos") <= most_head)).withColumnRenamed("conv", "first")
    taken = sizes.where("head > 0").join(heads, "first").where("pos <= head")
    taken = taken.select("conv", F.col("pos").cast("long").alias("depth"), "t1", "t2", "chars", F.col("length").cast("long"))
    own = numbered.where(F.col("pos") > F.crc32(conv.cast("string").cast("binary")) % (most_head + 1))
    with_own = sizes.where("n > h").select("conv", "length", (F.col("head") - F.col("h")).alias("shift"))
    return _roots(sizes).union(taken).union(_own_turns(own, with_own, band))


def _prefixes(turns: DataFrame, band: int) -> DataFrame:
    """Adds ``p1``, ``p2``, the hash of the prefix that ends with the turn."""
    for i in (1, 2):
        mixed = F.xxhash64(F.lit(i), "depth", "t1", "t2")
        turns = turns.withColumn(f"z{i}", F.when(F.col("depth") > 0, mixed).otherwise(F.lit(0).cast("long")))
    turns = turns.withColumn("band", F.expr(f"depth div {band}")).drop("t1", "t2")
    run = Window.partitionBy("conv", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    turns = spill(turns, "trie-turns")
    carried = turns.where(F.col("length") >= band).groupBy("conv", "band")
    carried = carried.agg(F.bit_xor("z1").alias("c1"), F.bit_xor("z2").alias("c2"))
    carried = carried.select("conv", "band", *(F.bit_xor(c).over(before).alias(c) for c in ("c1", "c2"))).where("band > 0")
    inner = turns.select("conv", "depth", "length", "chars", "band", *(F.bit_xor(f"z{i}").over(run).alias(f"p{i}") for i in (1, 2)))
    whole = [F.col(f"p{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))).alias(f"p{i}") for i in (1, 2)]
    return inner.join(carried, ["conv", "band"], "left").select("conv", "depth", "length", "chars", *whole)


class SpillingQueue:
    """A priority queue, smallest tuple first: beyond ``limit`` entries its heap is
    written as a sorted run, and runs are merged as they are taken from."""

    def __init__(self, limit: int) -> None:
        self.limit, self.heap, self.runs, self.made = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder or None)
        self.heap.sort()
        for i in range(0, len(self.heap), _RUN):
            pickle.dump(self.heap[i : i + _RUN], file)
        file.seek(0)
        run = self._read(file)
        heapq.heappush(self.runs, (next(run), self.made, run))
        self.heap, self.made = [], self.made + 1

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def first(self) -> tuple | None:
        tops = [x for x in (self.heap[0] if self.heap else None, self.runs[0][0] if self.runs else None) if x is not None]
        return min(tops, default=None)

    def pop(self) -> tuple:
        item = self.first()
        if self.heap and self.heap[0] == item:
            return heapq.heappop(self.heap)
        _, number, run = self.runs[0]
        after = next(run, None)
        if after is None:
            heapq.heappop(self.runs)
        else:
            heapq.heapreplace(self.runs, (after, number, run))
        return item


_SWEPT = "conv long, depth long, parent long, n long, n_children long, n_leaves long, saved long"


def _sweep(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Time-forward processing of rows (shard_conv, shard_depth, depth, conv, kind,
    to_depth, to_conv, parent, n, children, leaves, saved), sorted by shard, then by falling
    depth, conv and kind. Kind 0 is a message to (depth, conv), 1 a node; totals go on to
    (to_depth, to_conv), if not null."""
    at, queue = None, SpillingQueue(limit)
    names = [x.split()[0] for x in _SWEPT.split(", ")]
    for batch in batches:
        out = []
        for shard_conv, shard_depth, depth, conv, kind, to_depth, to_conv, parent, n, children, leaves, saved in zip(
            *(c.to_pylist() for c in batch.columns)
        ):
            if (shard_conv, shard_depth) != at:
                at, queue = (shard_conv, shard_depth), SpillingQueue(limit)
            if kind == 0:
                queue.push((-depth, conv, children, leaves, saved))
                continue
            while (top := queue.first()) is not None and top[:2] == (-depth, conv):
                queue.pop()
                children, leaves, saved = children + top[2], leaves + top[3], saved + top[4]
            out.append((conv, depth, parent, n, children, leaves, saved))
            if to_conv is not None:
                queue.push((-to_depth, to_conv, 1, leaves, saved))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)


def _swept(rows: DataFrame, limit: int) -> DataFrame:
    order = ["shard_conv", "shard_depth", F.desc("depth"), "conv", "kind"]
    return rows.sortWithinPartitions(*order).mapInArrow(lambda b: _sweep(b, limit), _SWEPT)


def _null() -> Column:
    return F.lit(None).cast("long")


def _zero() -> Column:
    return F.lit(0).cast("long")


def prefix_trie(turns: DataFrame, band: int = BAND, queue_limit: int = QUEUE_LIMIT) -> DataFrame:
    """(conv, depth, parent, n, n_children, n_leaves, saved, ends_sha256) for every node
    of the conversations in ``turns`` (as `rebuilt_turns` returns them)."""
    paths = spill(_prefixes(turns, band), "trie-paths")
    ends = F.sum((F.col("length") == F.col("depth")).cast("long"))
    key = ["depth", "p1", "p2"]
    nodes = paths.groupBy(*key).agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n"), ends.alias("ends"), F.max("chars").alias("size")
    )
    nodes = spill(nodes, "trie-nodes")
    crowd = math.isqrt(nodes.agg(F.sum("n")).first()[0] or 0)
    # n sums to the rows over all nodes: at most rows / crowd nodes are crowded
    crowded, sparse = F.broadcast(nodes.where(F.col("n") > crowd)), nodes.where(F.col("n") <= crowd)
    known = paths.join(crowded, key).unionByName(paths.join(crowded, key, "left_anti").join(sparse, key))

    fragments = _fragments(known, crowd, band)
    sums = spill(
        fragments.groupBy("shard_conv", "shard_depth").agg(
            F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"),
            F.max(F.when(_is_top(), F.col("parent"))).alias("to_conv"),
        ),
        "trie-fragments",
    ).withColumn("to_depth", F.col("shard_depth") - 1)
    messages = _messages(fragments, sums, queue_limit)
    rows = fragments.select(
        "shard_conv", "shard_depth", "depth", "conv", F.lit(1).alias("kind"),
        F.when(~_is_top(), F.col("depth") - 1).alias("to_depth"), F.when(~_is_top(), F.col("parent")).alias("to_conv"),
        "parent", "n", _zero().alias("children"), "leaves", "saved",
    ).union(messages)
    found = _swept(rows.repartition("shard_conv", "shard_depth"), queue_limit)
    digests = _end_digests(known.where(F.col("depth") == F.col("length")).select("rep", "depth", "conv"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return found.join(digests, ["conv", "depth"], "left").select(
        *(x.split()[0] for x in _SWEPT.split(", ")), F.coalesce("ends_sha256", none).alias("ends_sha256")
    )


def _is_top() -> Column:
    """Whether a node is the root of its fragment."""
    return (F.col("conv") == F.col("shard_conv")) & (F.col("depth") == F.col("shard_depth"))


def _fragments(known: DataFrame, crowd: int, band: int) -> DataFrame:
    """One row a node: its fragment's root (``shard_conv``, ``shard_depth``), its parent,
    and what it has by itself. ``known``: every conversation's nodes along its path."""
    here = F.col("depth").cast("long")
    bands = F.array_distinct(F.array(F.expr(f"depth div {band}"), F.expr(f"(depth + 1) div {band}")))
    # the last node of a band also leads into the next, as the parent of its first
    along = known.select("conv", here.alias("depth"), "rep", "n", "ends", "size", F.explode(bands).alias("band"))
    inside = F.col("depth") >= F.col("band") * band
    order = Window.partitionBy("conv", "band").orderBy("depth")
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    sparse = inside & (F.col("n") <= crowd)
    top = F.first(F.when(sparse, F.struct("rep", "depth")), ignorenulls=True).over(run)
    start = F.first(F.when(inside, F.struct("rep", "depth")), ignorenulls=True).over(run)
    along = along.select(
        "conv", "depth", "rep", "n", "ends", "size", inside.alias("inside"),
        F.lag("rep").over(order).alias("parent"), F.coalesce(top, start).alias("top"),
    )
    own = along.where("inside and rep = conv").select(
        F.col("top.rep").alias("shard_conv"),
        F.col("top.depth").alias("shard_depth"),
        "conv",
        "depth",
        "parent",
        "n",
        (F.col("n") == F.col("ends")).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("size")).alias("saved"),
    )
    return spill(own, "trie-rows")


def _messages(fragments: DataFrame, sums: DataFrame, queue_limit: int) -> DataFrame:
    """What fragments pass to the nodes they hang from, one row a node, as `_sweep`
    reads messages."""
    at = ["to_conv", "to_depth"]
    hung = sums.where("to_conv is not null")
    places = hung.groupBy(*at).agg(F.count(F.lit(1)).alias("n_hung"))
    hosts = places.join(
        fragments.select("shard_conv", "shard_depth", F.col("conv").alias("to_conv"), F.col("depth").alias("to_depth")), at
    )
    hosts = spill(hosts, "trie-hosts").drop("n_hung")  # nodes with fragments below, and their own fragments
    shard = ["shard_conv", "shard_depth"]
    inner = hosts.select(*shard).distinct()
    total = [F.sum(c).alias(c) for c in ("children", "leaves", "saved")]
    folded = hung.join(inner, shard, "left_anti").withColumn("children", F.lit(1).cast("long")).groupBy(*at).agg(*total)
    folded = spill(folded, "trie-folded")
    # across shard roots: a fragment's own sum, what its plain fragments pass, its host
    below = folded.join(hosts, at).groupBy(*shard).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    roots = sums.join(inner, shard).join(below, shard, "left")
    up = hosts.select(*at, F.col("shard_conv").alias("host_conv"), F.col("shard_depth").alias("host_depth"))
    roots = roots.join(up, at, "left").select(
        _zero().alias("shard_conv"), _zero().alias("shard_depth"),
        F.col("shard_depth").alias("depth"), F.col("shard_conv").alias("conv"), F.lit(1).alias("kind"),
        F.col("host_depth").alias("to_depth"), F.col("host_conv").alias("to_conv"), F.col("to_conv").alias("parent"),
        _zero().alias("n"), _zero().alias("children"),
        (F.col("leaves") + F.coalesce("more_leaves", _zero())).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", _zero())).alias("saved"),
    )
    swept = _swept(roots.repartition(1), queue_limit).where("parent is not null")
    passed = folded.union(
        swept.select(F.col("parent"), F.col("depth") - 1, F.lit(1).cast("long"), F.col("n_leaves"), F.col("saved"))
    )
    passed = passed.groupBy(*at).agg(*total).join(hosts, at)
    return passed.select(
        "shard_conv", "shard_depth", F.col("to_depth").alias("depth"), F.col("to_conv").alias("conv"), F.lit(0).alias("kind"),
        _null().alias("to_depth"), _null().alias("to_conv"), _null().alias("parent"), _zero().alias("n"),
        "children", "leaves", "saved",
    )


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (rep, depth, conv): up to ``_IDS`` ids of a node, comma-joined."""
    names = ["rep", "depth", "first", "ids"]
    for batch in batches:
        out, at, ids = [], None, []
        for rep, depth, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if (rep, depth) != at or len(ids) == _IDS:
                if ids:
                    out.append((*at, ids[0], ",".join(map(str, ids))))
                at, ids = (rep, depth), []
            ids.append(conv)
        if ids:
            out.append((*at, ids[0], ",".join(map(str, ids))))
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in columns[:3]), pa.array(columns[3])], names=names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted stretches: each node's digest, one update a stretch."""
    at, digest = None, None

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in list(zip(*rows))[:2]), pa.array([r[2] for r in rows])],
            names=["conv", "depth", "ends_sha256"],
        )

    for batch in batches:
        done = []
        for rep, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (rep, depth) != at:
                if at:
                    done.append((*at, digest.hexdigest()))
                at, digest = (rep, depth), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if done:
            yield out(done)
    if at:
        yield out([(*at, digest.hexdigest())])


def _end_digests(members: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256) of the nodes where conversations end."""
    order = ["rep", "depth", "conv"]
    stretches = members.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _stretches, "rep long, depth long, first long, ids string"
    )
    order = ["rep", "depth", "first"]
    stretches = stretches.repartition("rep", "depth").sortWithinPartitions(*order)
    return stretches.mapInArrow(_hashed, "conv long, depth long, ends_sha256 string")


def op12_time_forward_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = spill(number_turns(table(spark, sf_dir, "conversations")), "numbered-turns")
    found = prefix_trie(rebuilt_turns(numbered))
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


#: crc32 has no function in SQL: the table of its bytes and the digits' steps are recursions.
OP12_SQL = f"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM (SELECT unnest(range(0, 256)) AS i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
),
steps AS (SELECT i, v AS x FROM bits WHERE k = 8),
own AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
crc(c, s, k, v) AS (
  SELECT c, CAST(c AS VARCHAR), 1, CAST(4294967295 AS BIGINT) FROM own
  UNION ALL SELECT c, s, k + 1, xor(x, v >> 8) FROM crc JOIN steps ON i = xor(v, CAST(ascii(s[k]) AS BIGINT)) & 255 WHERE k <= length(s)
),
h AS (SELECT c, xor(v, 4294967295) % {MOST_HEAD + 1} AS h FROM crc WHERE k = length(s) + 1),
rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.l[1:h], []), o.l[h + 1:]) AS s
  FROM own o JOIN h ON h.c = o.c LEFT JOIN own b ON b.c = o.c - o.c % {FAMILY}
),
path AS (SELECT c, len(s) AS n, d, s[1:d] AS k FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT d, k, min(c) AS id, count(*) AS n_convs, count(*) FILTER (n = d) AS n_ends,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d) AS ends
  FROM path GROUP BY d, k
),
placed AS (SELECT c, path.d, id, n_convs = n_ends AS leaf, CASE WHEN path.d > 0 THEN (n_convs - 1) * length(path.k[path.d].x) ELSE 0 END AS saved
       FROM path JOIN node ON path.d = node.d AND path.k = node.k),
below AS (
  SELECT DISTINCT a.id, a.d, b.id AS id2, b.d AS d2, b.leaf, b.saved FROM placed a JOIN placed b ON a.c = b.c AND b.d >= a.d
),
total AS (
  SELECT id, d, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved, count(*) FILTER (d2 = d + 1) AS n_children
  FROM below GROUP BY id, d
)
SELECT node.id AS conv_id, CAST(node.d AS BIGINT) AS depth, up.id AS parent_conv_id, node.n_convs, n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN total ON total.id = node.id AND total.d = node.d
LEFT JOIN node up ON up.d = node.d - 1 AND up.k = node.k[1:node.d - 1] AND node.d > 0
"""
