"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are 64-bit SimHashes of word shingles. Candidates come from
2^(r+1) - 1 bit masks (r the largest distance): bit i gets a vector m(i) of r+1
bits, and mask v holds the bits with <m(i), v> = 1 (mod 2). For any r bits some
v is orthogonal to all their vectors, so two fingerprints that differ in at most
r bits agree under that mask: no pair within the radius is lost, by
construction and not by chance.

Only different fingerprints are compared, each once. Those that agree under a
mask meet in one run of a sorted partition; the run gives a spanning forest of
its links (at most one link per fingerprint), never all pairs. A run longer
than ``run_limit`` is not gathered but masked again on its open bits: its
members already agree under the first mask, so the same guarantee holds for
the 31 finer masks, and after three levels a run shares so many bits that it
cannot be long. The forests' components (``components``) are the classes.

Defined results: null, empty and white-space texts have fingerprint 0 and link
like any other; repeated rows and texts share a fingerprint; a null doc_id takes
part but names no component (a class of null ids only has a null id); an empty
table stays empty. Columns of the input are kept; those named like an output
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.llm.components import components
from stayledger.llm.frames import cut, doc_key, spill, table
from stayledger.llm.textbytes import FOLD_SPACE, texts

BITS = 64


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``words`` words, repeats included."""
    parts = (text or b"").translate(FOLD_SPACE).split()
    if not parts:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    first = np.concatenate(([0], ends[:-words])).tolist()
    last = (ends[words - 1 :] - 1).tolist()
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(first, last)), np.uint64, len(first))


def majority_bits(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half of the hashes (0 for no hashes)."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def simhash(text: Column, words: int = 4) -> Column:
    """The fingerprint as a long (the bits, signed)."""

    @F.arrow_udf("long")
    def fingerprint(column: pa.Array) -> pa.Array:
        found = [majority_bits(shingle_hashes(t, words)) for t in texts(column)]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return fingerprint(text)


def covering_masks(radius: int, bits: list[int]) -> list[int]:
    """The masks over the given bit places (signed longs)."""
    top = 1 << (radius + 1)
    vector = {bit: 1 + i % (top - 1) for i, bit in enumerate(bits)}
    masks = [sum(1 << bit for bit, m in vector.items() if (m & v).bit_count() & 1) for v in range(1, top)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among different fingerprints: breadth
    first, each step comparing a slice of the frontier with what is left."""
    left, links = prints, []
    while len(left) > 1:
        root, frontier, left = left[0], left[:1], left[1:]
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(frontier), 64):
                open_ = np.flatnonzero(~near)
                apart = np.bitwise_count(frontier[at : at + 64, None] ^ left[None, open_])
                near[open_[(apart <= radius).any(0)]] = True
            frontier, left = left[near], left[~near]
            links += [(int(root), int(x)) for x in frontier]
    return links


def _link_runs(batches: Iterator[pa.RecordBatch], radius: int, run_limit: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (mask, key): links of each run as (level -1, a, b); rows of
    runs beyond the limit as they are, to be masked again."""
    carry = None  # rows of the last, perhaps unfinished run
    over = None  # (mask, key) of a run that passed the limit

    def out(mask, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(x, np.int64)) for x in (mask, a, b)], names=["mask", "a", "b"]
        )

    def solve(mask, key, fp):
        """Whole runs only."""
        starts = np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))))
        sizes = np.diff(np.append(starts, len(mask)))
        two = starts[sizes == 2]
        near = np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= radius
        a, b = list(fp[two][near]), list(fp[two + 1][near])
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            for x, y in spanning_links(fp[s : s + n].view(np.uint64), radius):
                a.append(np.uint64(x).view(np.int64))
                b.append(np.uint64(y).view(np.int64))
        if a:
            yield out([-1] * len(a), a, b)

    for batch in batches:
        mask, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(mask):
            continue
        if over is not None:  # the rest of a long run passes through
            n = int(((mask == over[0]) & (key == over[1])).sum())
            if n:
                yield out(mask[:n], fp[:n], fp[:n])
                mask, key, fp = mask[n:], key[n:], fp[n:]
            if not len(mask):
                continue
            over = None
        if carry is not None:
            mask, key, fp = (np.concatenate(x) for x in zip(carry, (mask, key, fp)))
        tail = len(mask) - int(((mask == mask[-1]) & (key == key[-1])).sum())
        yield from solve(mask[:tail], key[:tail], fp[:tail]) if tail else ()
        carry = (mask[tail:], key[tail:], fp[tail:])
        if len(carry[0]) > run_limit:
            over = (carry[0][0], carry[1][0])
            yield out(carry[0], carry[2], carry[2])
            carry = None
    if carry is not None and len(carry[0]) > 1:
        yield from solve(*carry)


def fingerprint_links(prints: DataFrame, radius: int = 4, run_limit: int = 8192) -> DataFrame:
    """(a, b): a spanning set of the links between the different values of the
    long column ``fingerprint``."""
    level = covering_masks(radius, list(range(BITS)))
    rows = prints.select(
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for m in level])
        ).alias("m"),
        F.col("fingerprint").alias("fp"),
    ).select("m.mask", "m.key", "fp")
    links = None
    for depth in range(4):
        limit = run_limit if depth < 3 else 1 << 62
        found = (
            rows.repartition("mask", "key")
            .sortWithinPartitions("mask", "key", "fp")
            .mapInArrow(lambda b, limit=limit: _link_runs(b, radius, limit), "mask long, a long, b long")
        )
        found = cut(found)
        here = found.where("mask = -1").select("a", "b")
        links = here if links is None else links.union(here)
        long_runs = found.where("mask <> -1").select("mask", F.col("a").alias("fp"))
        if depth == 3 or long_runs.isEmpty():
            return links
        rows = long_runs.select(F.explode(_finer(F.col("mask"), radius)).alias("mask"), "fp").select(
            "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
        ).distinct()
    return links


def _finer(mask: Column, radius: int) -> Column:
    """The mask joined with each covering mask of the bits it leaves open."""

    @F.arrow_udf("array<long>")
    def finer(column: pa.Array) -> pa.Array:
        known: dict[int, list[int]] = {}
        for m in column.to_pylist():
            if m not in known:
                known[m] = [_signed(m | f) for f in covering_masks(radius, [i for i in range(BITS) if not (m >> i) & 1])]
        return pa.array([known[m] for m in column.to_pylist()], pa.list_(pa.int64()))

    return finer(mask)


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _marked(docs: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, doc: its key, fingerprint) of every row."""
    key = doc_key(F.col(doc_id), F.col(text))
    return cut(docs.select(F.col(doc_id).alias("doc_id"), key.alias("doc"), simhash(F.col(text), words).alias("fingerprint")))


def _named(marked: DataFrame, radius: int, name: Column) -> DataFrame:
    """(fingerprint, name): the class of each fingerprint, named by an aggregate of
    the rows that is itself a minimum of minima."""
    prints = marked.groupBy("fingerprint").agg(name.alias("least"))
    roots = components(fingerprint_links(prints.select("fingerprint"), radius), "a", "b")
    classes = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    # both written: plain scans, so that a hot root is split, or the few names are broadcast
    classes = spill(classes, "simhash-classes")
    named = spill(classes.groupBy("root").agg(F.min("least").alias("name")), "simhash-names")
    return classes.join(named, "root").select("fingerprint", "name")


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for every row: the class is named
    by its smallest doc_id."""
    marked = _marked(docs, words, doc_id, text)
    named = _named(marked, radius, F.min("doc_id"))
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", F.col("name").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class: that of the smallest doc_id (a null
    one comes last, equal ones go by text); rows that repeat it stay once."""
    marked = _marked(docs, words, doc_id, text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "doc"))
    kept = _named(marked, radius, first).select("name.doc").distinct()
    keyed = docs.select(F.struct("*").alias("row"), doc_key(F.col(doc_id), F.col(text)).alias("doc"))
    return keyed.dropDuplicates(["doc"]).join(kept, "doc", "left_semi").select("row.*")


def op6_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
