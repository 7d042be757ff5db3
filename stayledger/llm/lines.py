"""Line dedup for fuzzy lines: MinHash, exact check, union-find.

A line is folded (A-Z lower-cased, white space runs to one space, ends trimmed);
lines of ``min_chars`` folded characters or more are judged (at least a shingle:
by default all that have one), shorter ones (blank lines, brackets) always stay. Two
lines are alike when the Jaccard similarity of their sets of ``shingle``-character
shingles is ``similarity`` or more; likeness is closed transitively, and of each
component the first line (smallest doc_id, then place) is kept.

1. Signatures: one hash per shingle, the minimum kept in each of
   ``bands * rows`` bins (one-permutation MinHash; an empty bin borrows from
   another by a fixed order). ``bands`` bands of ``rows`` bins each give a line
   that many buckets: at similarity 0.8, 1 - (1 - 0.8^5)^12 = 0.991 of the pairs
   meet, at 0.85 0.999, while unrelated lines of one language (about 0.03)
   practically never do. Only (bucket, line hash) is shuffled, and only once per
   different line of a stretch of text, so a line that a third of all documents
   hold costs a few rows.
2. Buckets that hold different lines are kept. A bucket's members meet again
   with their texts (only candidates' texts are joined) and are compared
   exactly; each yields a spanning forest of its links, never all pairs. Buckets of
   more than ``run_limit`` lines are taken apart, without leaving a pair out
   (`_long_links`).
3. ``components`` joins the forests, exact repeats already being one node. The
   first place of each line is aggregated before the shuffle.

Lines are known by a 64-bit hash of the folded line; two different lines share
one with probability n^2 / 2^65.

Defined results: null and empty texts have no judged lines and stay as they are;
rows that repeat doc_id and text are one document and get the same result; a null
doc_id comes after all others; empty tables stay empty. Columns of the input are
kept; those named like an output are replaced. Work on a very long text grows with
its lines, on a very long line with its shingles; both are held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.llm.components import components
from stayledger.llm.frames import doc_key, spill, table
from stayledger.llm.textbytes import FOLD_LINES, batches_by_bytes, texts

SHINGLE, SIMILARITY, MIN_CHARS = 8, 0.8, 8
BANDS, ROWS = 12, 5
RUN_LIMIT = 512
_FEW = 24  # lines of a group that are compared one by one
_STRETCH = 4 << 20
_CHUNK = 1 << 18  # characters whose arrays stay in the processor's cache
_FULL = np.uint32(0xFFFFFFFF)


def fold_lines(text: bytes | None) -> list[bytes]:
    folded = (text or b"").translate(FOLD_LINES)
    if b"  " in folded:
        return [b" ".join(x.split()) for x in folded.split(b"\n")]
    return [x.strip(b" ") for x in folded.split(b"\n")]  # no run of spaces


def line_hash(line: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(line)
    return h - (1 << 64) if h >> 63 else h


def _judged(line: bytes, min_chars: int) -> bool:
    if len(line) < min_chars:
        return False
    return len(line) >= 4 * min_chars or len(line.decode()) >= min_chars


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _windows(points: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` code points (a power of two by doubling)."""
    base, top = 0x9E3779B97F4A7C15, (1 << 64) - 1
    h, have, scale = points.astype(np.uint64), 1, base
    while have * 2 <= width:
        h, after = h[:-have] * np.uint64(scale), h[have:]
        h += after
        have, scale = have * 2, scale * scale & top
    while have < width:
        h = h[:-1] * np.uint64(base) + points[have : have + len(h) - 1]
        have += 1
    return _mix(h)


def buckets(lines: list[bytes], shingle: int, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket for each line and band. Lines have ``shingle`` characters or more."""
    n_bins = bands * rows
    joined = b"\n".join(lines).decode().encode("utf-32-le")
    points = np.frombuffer(joined, np.uint32)
    ends = np.append(np.flatnonzero(points == 10), len(points))
    size = np.diff(np.concatenate(([-1], ends)))  # with the newline
    h = _windows(points, shingle)
    slot = h >> np.uint64(32)
    slot *= np.uint64(n_bins)
    slot >>= np.uint64(32)
    slot = slot.view(np.int64)
    slot += np.repeat(np.arange(0, len(lines) * n_bins, n_bins), size)[: len(h)]
    value = h.astype(np.uint32)
    value &= np.uint32(0xFFFFFFFE)
    over = (ends[:-1, None] - np.arange(shingle)).ravel()  # windows that reach into the next line
    value[over] = _FULL
    least = np.full(len(lines) * n_bins, _FULL, np.uint32)
    np.minimum.at(least, slot, value)
    own = least.reshape(len(lines), n_bins)
    full = own.copy()
    r, c = np.nonzero(own == _FULL)
    attempt = 0
    while len(r):  # every line has a shingle, so some bin lends
        attempt += 1
        lender = _mix(np.arange(n_bins, dtype=np.uint64) + np.uint64(attempt << 20)) % np.uint64(n_bins)
        got = own[r, lender[c].astype(np.int64)]
        full[r, c] = got
        open_ = got == _FULL
        r, c = r[open_], c[open_]
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(lines), 1))
    for j in range(rows):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += full[:, j::rows]
        out = _mix(out)
    return out


def _bucket_rows(batches: Iterator[pa.RecordBatch], o: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = texts(batch.column(0))
        for first, end in batches_by_bytes(values, _STRETCH):
            lines = {line_hash(x): x for t in values[first:end] for x in fold_lines(t) if _judged(x, o["min_chars"])}
            if lines:
                own = list(lines.values())
                found = np.concatenate(
                    [buckets(own[a:z], o["shingle"], o["bands"], o["rows"]) for a, z in batches_by_bytes(own, _CHUNK)]
                )
                keys = np.repeat(np.fromiter(lines, np.int64, len(lines)), o["bands"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.reshape(-1).view(np.int64)), pa.array(keys)], names=["bucket", "key"]
                )


def _shared_buckets(batches: Iterator[pa.RecordBatch], run_limit: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: the members of buckets with different keys. A small
    bucket is renamed after its members, so that the bands two lines share give
    one group; a long one streams through under its own number (perhaps with
    repeats, which the caller drops)."""
    held = None  # (number, different keys) of the unfinished bucket
    long = None  # number of a bucket that streams

    def out(bucket, key):
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(key, pa.int64())], names=["bucket", "key"])

    def named(keys: np.ndarray) -> int:
        h = xxhash.xxh3_64_intdigest(keys.tobytes())
        return h - (1 << 64) if h >> 63 else h

    for batch in batches:
        bucket, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if long is not None:
            n = int((bucket == long).sum())  # sorted: they come first
            if n:
                yield out(np.full(n, long), key[:n])
            bucket, key = bucket[n:], key[n:]
            if len(bucket):
                long = None
        if not len(bucket):
            continue
        if held is not None:
            bucket = np.concatenate((np.full(len(held[1]), held[0]), bucket))
            key = np.concatenate((held[1], key))
        starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        ends = np.append(starts[1:], len(bucket))
        names, members = [], []
        more = np.flatnonzero(ends[:-1] - starts[:-1] > 1)
        for s, e in zip(starts[more].tolist(), ends[more].tolist()):
            keys = np.unique(key[s:e])
            if len(keys) > 1:
                names.append(np.full(len(keys), named(keys) if len(keys) <= run_limit else bucket[s]))
                members.append(keys)
        if names:
            yield out(np.concatenate(names), np.concatenate(members))
        held = (bucket[-1], np.unique(key[starts[-1] :]))
        if len(held[1]) > run_limit:
            long, tail, held = held[0], held[1], None
            yield out(np.full(len(tail), long), tail)
    if held is not None and len(held[1]) > 1:
        yield out(np.full(len(held[1]), named(held[1])), held[1])


def _line_rows(batches: Iterator[pa.RecordBatch], o: dict) -> Iterator[pa.RecordBatch]:
    """(key, line) once per different line of a stretch."""
    for batch in batches:
        values = texts(batch.column(0))
        for first, end in batches_by_bytes(values, _STRETCH):
            lines = {line_hash(x): x for t in values[first:end] for x in fold_lines(t) if _judged(x, o["min_chars"])}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(lines), pa.int64()), pa.array(list(lines.values()), pa.binary()).cast(pa.string())],
                names=["key", "line"],
            )


def shingle_set(line: str, shingle: int) -> np.ndarray:
    """The line's different shingles as sorted numbers. Exact: up to eight characters
    of one byte each are packed into a number; other lines go by the shingles'
    places in their own sorted list (see `_sets`)."""
    raw = line.encode("latin-1").ljust(shingle, b"\0")
    n = len(raw) - shingle + 1
    words = np.ndarray((n,), np.uint64, raw + b"\0" * 8, strides=(1,)).copy()  # eight bytes from each place
    if shingle < 8:
        words &= np.uint64((1 << 8 * shingle) - 1)
    words.sort()
    return words[np.concatenate(([True], words[1:] != words[:-1]))]


def _sets(lines: list[str], shingle: int) -> list[np.ndarray]:
    """The shingle sets of lines that are to be compared."""
    try:
        if shingle <= 8:
            return [shingle_set(x, shingle) for x in lines]
    except UnicodeEncodeError:
        pass
    number: dict[str, int] = {}
    of = [{x[i : i + shingle] for i in range(max(1, len(x) - shingle + 1))} for x in lines]
    return [np.array(sorted(number.setdefault(g, len(number)) for g in x), np.uint64) for x in of]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    both = np.concatenate((a, b))
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def like_links(lines: list[str], shingle: int, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest (index pairs) of the pairs whose exact Jaccard similarity
    reaches ``similarity``: breadth first over what is left."""
    sets = _sets(lines, shingle)
    if len(lines) > _FEW:
        return _many_links(sets, similarity)
    left, links = list(range(len(lines))), []

    def like(a: np.ndarray, b: np.ndarray) -> bool:
        if min(len(a), len(b)) < similarity * max(len(a), len(b)):
            return False
        both = _common(a, b)
        return both >= similarity * (len(a) + len(b) - both)

    while left:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and left:
            at, near = frontier.pop(), []
            for i in left:
                if like(sets[at], sets[i]):
                    near.append(i)
                    links.append((at, i))
            if near:
                gone = set(near)
                left = [i for i in left if i not in gone]
                frontier += near
    return links


def _many_links(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """The links of `like_links`, one line being counted against all that are left at once."""
    size = np.array([len(x) for x in sets])
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    start = np.cumsum(size) - size
    held = np.zeros(int(number.max()) + 1, bool)
    left, links = np.arange(len(sets)), []
    while len(left):
        root, left = int(left[0]), left[1:]
        frontier = [root]
        while frontier and len(left):
            at = frontier.pop()
            own, n = number[start[at] : start[at] + size[at]], size[at]
            near = left[np.minimum(size[left], n) >= similarity * np.maximum(size[left], n)]
            if not len(near):
                continue
            held[own] = True
            first = np.cumsum(size[near]) - size[near]
            of = np.repeat(start[near] - first, size[near]) + np.arange(int(size[near].sum()))
            both = np.add.reduceat(held[number[of]], first, dtype=np.int64)
            held[own] = False
            near = near[both >= similarity * (n + size[near] - both)]
            if len(near):
                links += [(at, i) for i in near.tolist()]
                left = np.setdiff1d(left, near, assume_unique=True)
                frontier += near.tolist()
    return links


def _solved(batches: Iterator[pa.RecordBatch], o: dict) -> Iterator[pa.RecordBatch]:
    """Rows (g, i, j, key, line) sorted by group (g, i, j): the links of each group."""
    group, keys, lines = None, [], []

    def solve():
        return [(keys[a], keys[b]) for a, b in like_links(lines, o["shingle"], o["similarity"])]

    for batch in batches:
        found = []
        for *at, key, line in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if at != group:
                found += solve()
                group, keys, lines = at, [], []
            if not keys or keys[-1] != key:
                keys.append(key)
                lines.append(line)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])
    found = solve()
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])


def _solve(rows: DataFrame, o: dict) -> DataFrame:
    """Links (a, b) of the lines of each group, of rows (g, i, j, key, line)."""
    return (
        rows.select("g", "i", "j", "key", "line")
        .repartition("g", "i", "j")
        .sortWithinPartitions("g", "i", "j", "key")
        .mapInArrow(lambda b: _solved(b, o), "a long, b long")
    )


def _pieces(batches: Iterator[pa.RecordBatch], o: dict) -> Iterator[pa.RecordBatch]:
    """(bucket, key, line) -> (bucket, key, piece), a row for each different shingle."""
    for batch in batches:
        for bucket, key, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = {line_hash(line[i : i + o["shingle"]].encode()) for i in range(len(line) - o["shingle"] + 1)}
            n = len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket] * n, pa.int64()), pa.array([key] * n, pa.int64()), pa.array(list(own), pa.int64())],
                names=["bucket", "key", "piece"],
            )


def _long_links(met: DataFrame, line: DataFrame, o: dict) -> list[DataFrame]:
    """Links of the members (bucket, key) of buckets with more than ``run_limit`` lines:
    what comparing all of them would connect, without all pairs.

    A shingle is common in a bucket if more than ``run_limit`` of its lines hold it, else
    rare; x has h_x common and r_x rare ones. Two alike lines that share a rare shingle
    share one among their first size - similarity * size + 1 in the order of how many
    lines hold it (the prefix filter): these lines meet by it, at most ``run_limit``
    together. Two alike lines that share none have r_x + r_y <= w * min(h_x, h_y), w =
    1 / similarity - 1, so that one of them has r <= w / 2 * h, the other r <= w * h. Of
    the former, those with the same common shingles are alike, and whatever is alike to
    one of them is so to the one with the least r. Only these meet the latter, in
    pairs of blocks: few for lines of some templates, whatever their number."""
    rows = spill(met.join(line, "key").select("bucket", "key", "line"), "long-buckets")
    limit, over = o["run_limit"], 1 / o["similarity"] - 1 + 1e-9
    pieces = spill(rows.repartition("bucket", "key").mapInArrow(lambda b: _pieces(b, o), "bucket long, key long, piece long"), "long-pieces")
    held = spill(pieces.groupBy("bucket", "piece").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= limit), "long-rare")
    sizes = pieces.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor("piece").alias("every"))
    rare = pieces.join(held, ["bucket", "piece"]).groupBy("bucket", "key")
    rare = rare.agg(F.sort_array(F.collect_list(F.struct("n", "piece"))).alias("rare"), F.bit_xor("piece").alias("some"))
    known = sizes.join(rare, ["bucket", "key"], "left").withColumn("r", F.coalesce(F.size("rare"), F.lit(0)))
    known = known.withColumn("h", F.col("size") - F.col("r"))
    common = F.col("every").bitwiseXOR(F.coalesce("some", F.lit(0))).alias("common")
    known = spill(known.select("bucket", "key", "size", "rare", "r", "h", common), "long-lines")
    first = F.col("size") - F.ceil(F.lit(o["similarity"] - 1e-9) * F.col("size")) + 1
    by_piece = known.where("r > 0").select("bucket", "key", F.explode(F.slice("rare", F.lit(1), first.cast("int"))).alias("p"))
    by_piece = by_piece.where("p.n > 1").select("bucket", F.col("p.piece").alias("i"), F.lit(0).alias("j"), "key")
    links = [_solve(by_piece.join(rows, ["bucket", "key"]).withColumnRenamed("bucket", "g"), o)]
    tops = known.where(F.col("r") <= over / 2 * F.col("h")).groupBy("bucket", "common", "h").agg(F.min(F.struct("r", "key")).alias("top"))
    sides = []
    for side in (tops.select("bucket", F.col("top.key").alias("key")), known.where(F.col("r") <= over * F.col("h")).select("bucket", "key")):
        n = side.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / limit).alias("blocks"))
        sides.append((side, spill(n, "long-blocks")))
    met = []
    for (side, n), (_, others), (own, other) in ((*sides, "ij"), (*sides[::-1], "ji")):
        placed = side.join(n, "bucket").join(others.withColumnRenamed("blocks", "others"), "bucket")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
        placed = placed.select("bucket", "key", F.pmod(F.xxhash64("key"), "blocks").alias(own), every.alias(other))
        met.append(placed.join(rows, ["bucket", "key"]).select(F.col("bucket").alias("g"), "i", "j", "key", "line"))
    links.append(_solve(met[0].union(met[1]), o))
    return links


def like_lines(docs: DataFrame, text: str, o: dict) -> DataFrame:
    """(node, root) of the lines that are like others (by line hash)."""
    rows = docs.select(text).mapInArrow(lambda b: _bucket_rows(b, o), "bucket long, key long")
    met = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda b: _shared_buckets(b, o["run_limit"]), "bucket long, key long"
    )
    met = spill(met, "line-buckets").distinct()
    keys = spill(met.select("key").distinct(), "line-keys")
    line = docs.select(text).mapInArrow(lambda b: _line_rows(b, o), "key long, line string")
    line = line.join(keys, "key").dropDuplicates(["key"])
    sizes = spill(met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "line-sizes")
    short = met.join(sizes.where(F.col("n") <= o["run_limit"]), "bucket")
    short = short.select(F.col("bucket").alias("g"), F.lit(0).alias("i"), F.lit(0).alias("j"), "key").join(line, "key")
    links = _solve(short, o)
    long = sizes.where(F.col("n") > o["run_limit"])
    if not long.isEmpty():
        for more in _long_links(met.join(long, "bucket"), line, o):
            links = links.union(more)
    return components(links, "a", "b")


def _places(batches: Iterator[pa.RecordBatch], o: dict) -> Iterator[pa.RecordBatch]:
    """(key, doc, id, at) for every judged line."""
    for batch in batches:
        key, row, at = [], [], []
        for r, t in enumerate(texts(batch.column(0))):
            for i, x in enumerate(fold_lines(t)):
                if _judged(x, o["min_chars"]):
                    key.append(line_hash(x))
                    row.append(r)
                    at.append(i)
        of = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), batch.column(1).take(of), batch.column(2).take(of), pa.array(at, pa.int32())],
            names=["key", "doc", "id", "at"],
        )


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc, removed): for each document (`doc_key`) that loses lines, their numbers
    (from 0, ascending)."""
    o = {"shingle": SHINGLE, "similarity": SIMILARITY, "min_chars": MIN_CHARS, "bands": BANDS, "rows": ROWS, "run_limit": RUN_LIMIT}
    o |= options
    o["min_chars"] = max(o["min_chars"], o["shingle"])
    rows = docs.select(F.col(text).alias("text"), doc_key(F.col(doc_id), F.col(text)).alias("doc"), F.col(doc_id).alias("id"))
    roots = like_lines(rows, "text", o)
    places = spill(
        rows.mapInArrow(lambda b: _places(b, o), f"key long, doc long, id {rows.schema['id'].dataType.simpleString()}, at int"),
        "line-places",
    )
    by_line = places.groupBy("key").agg(
        F.min(F.struct(F.col("id").isNull().alias("nil"), "id", "doc", "at")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    rooted = spill(
        by_line.join(roots, by_line["key"] == roots["node"], "left").select(
            "key", F.coalesce("root", "key").alias("root"), "first", "n"
        ),
        "line-roots",
    )
    kept = rooted.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("n")).where("n > 1")
    kept = spill(kept, "line-first")  # both sides of the join are plain scans: a hot root is split, or the few are broadcast
    judged = spill(rooted.join(kept.select("root", "kept"), "root").select("key", "kept.doc", "kept.at"), "line-kept")
    judged = judged.withColumnsRenamed({"doc": "kept_doc", "at": "kept_at"})
    gone = places.join(judged, "key").where("doc <> kept_doc or at <> kept_at")
    return spill(gone.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("removed")), "line-removed")


def _without(text: Column, removed: Column) -> Column:
    @F.arrow_udf("string")
    def rest(column: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for t, g in zip(texts(column), gone.to_pylist()):
            if t is not None and g:
                g = set(g)
                t = b"\n".join(x for i, x in enumerate(t.split(b"\n")) if i not in g)
            out.append(t)
        return pa.array(out, pa.binary()).cast(pa.string())

    return rest(text, removed)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the repeated lines: the columns of ``docs``, the text rewritten,
    ``n_chars`` (where present) following it. A document all of whose text went
    is left out: its every line stands elsewhere."""
    gone = repeated_lines(docs, doc_id, text, **options)
    keyed = docs.select(F.struct("*").alias("_row"), doc_key(F.col(doc_id), F.col(text)).alias("doc"))
    both = keyed.join(gone, "doc", "left")
    own = F.col("_row")[text]
    cut_text = _without(F.when(F.col("removed").isNotNull(), own), F.col("removed"))
    both = both.withColumn("_cut", cut_text).where("removed is null or trim(translate(_cut, '\\n\\r\\t', '   ')) <> ''")
    changed = F.col("removed").isNotNull()
    out = []
    for c in docs.columns:
        value = F.col("_row")[c]
        if c == text:
            value = F.when(changed, F.col("_cut")).otherwise(value)
        elif c == "n_chars":
            value = F.when(changed, F.length("_cut").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return both.select(*out)


def op8_minhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = repeated_lines(docs)
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    keyed = docs.select("doc_id", n_lines.cast("long").alias("n_lines"), doc_key(F.col("doc_id"), F.col("text")).alias("doc"))
    none = F.array().cast("array<int>")
    return keyed.join(gone, "doc", "left").select(
        "doc_id",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", none).alias("removed"),
    )
