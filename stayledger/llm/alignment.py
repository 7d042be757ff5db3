"""Alignment of two tokenizers' tokens of the same text.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file, applied to a space and the
text), tokenizer B a SentencePiece model (which puts that space in front itself).

1. Coarse cuts. A gives every token the characters it touches, B's proto the bytes
   of its surface. A token whose span, from the end before it, is as long as its
   decoded bytes ends where its span ends.
2. Refinement. Tokens that share a character (parts of a multibyte character, pieces
   ``<0xHH>``) have spans of other lengths; from the last exact cut on, they end where
   the lengths of their decoded bytes add up to.
3. Groups and links. Byte offsets where tokens of both end cut the text into groups.
   Every stretch between neighbouring cuts of either side belongs to one token of A
   and one of B, and every overlapping pair has one such stretch: a merge of two
   sorted lists finds all links, no pair is tried.

Chunks. Where neither vocabulary holds an entry that goes on over a space after
another character, no token crosses a single space between two characters that are
not white space, and a text is the sum of its chunks between such spaces. A worker
then tokenizes, aligns and links each different chunk of a stretch of text once, and
adds up the chunks of its documents (some 5 of 6 words of prose repeat within
megabytes). Other vocabularies, and texts with a chunk whose tokens do not spell it,
are taken whole.

Corpus-wide counts. Documents are taken in blocks of about ``block_bytes`` of text as
they stand in their partition. A block lists its different id pairs once, with the
number of its documents that hold each; only these lists are shuffled (some ten
thousand pairs for megabytes of text), summed by pair, and brought back to their
blocks. A document keeps its links as numbers into its block's list. A pair is at
most once in a block, so no key of these shuffles grows hot. Nothing is broadcast but
the tokenizers and, per id of A, its highest count (at most one row per id). Tokens
are computed once: what the blocks found is written to the shared folder.

Defined results: a null or empty text, and one whose tokens' bytes do not add up to
the space and the text (say, one with a literal U+2581, or broken UTF-8), has no
tokens: zero counts and an empty digest. Every row is a document: repeated rows count
each. An empty table gives no rows. Columns other than the key and the text are not
carried along, whatever their names. A very long text is a block of its own and takes
some 30 bytes of memory a byte of text.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayledger.llm.frames import spill, table
from stayledger.llm.textbytes import batches_by_bytes, texts

BYTE_BPE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20
_STRETCH = 1 << 20  # bytes of text encoded at a time
_CHUNKS = 500_000  # different chunks a worker knows at a time
_JOINED = 1000  # chunks tokenized together
SPACE = "▁"
_CUT, _CROSSED = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"\S (?:\S|$)")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level BPE writes for bytes: printable ones for themselves,
    the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE, " ").encode()


@dataclass
class Side:
    """A vocabulary: each id's decoded bytes and their lengths."""

    raw: list[bytes]
    size: np.ndarray


def _side(raw: list[bytes]) -> Side:
    return Side(raw, np.array([len(x) for x in raw], np.int64))


class Pair:
    """Both tokenizers, and the spans they give a text."""

    def __init__(self, byte_bpe: bytes, piece_model: bytes) -> None:
        self.a = tokenizers.Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        own = self.a.get_vocab(with_added_tokens=True)
        raw = [b""] * (max(own.values()) + 1)
        for entry, i in own.items():
            raw[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.side_a = _side(raw)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.side_b = _side([_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())])
        sides = (self.side_a.raw, [self.b.id_to_piece(i).replace(SPACE, " ").encode() for i in range(self.b.get_piece_size())])
        #: whether no token goes on over a space between characters that are not white space
        self.cuts = not any(_CROSSED.search(x.decode("utf-8", "replace")) for side in sides for x in side)
        n = len(raw)
        #: what a token's id is written as within a group (even) and at its end (odd); A's ids, then B's
        self.written = [b"%d%s" % (i, c) for i in range(n) for c in (b",", b"|")]
        self.written += [b"%d%s" % (i, c) for i in range(len(self.side_b.raw)) for c in (b",", b";")]

    def spans(self, values: list[bytes | None]) -> list[tuple | None]:
        """For each text (ids of A, their byte ends, ids of B, their byte ends) in the
        space and the text, or None without tokens."""
        own = [(i, v.decode("utf-8", "replace")) for i, v in enumerate(values) if v]
        out: list[tuple | None] = [None] * len(values)
        if not own:
            return out
        of_a = self.a.encode_batch([" " + t for _, t in own], add_special_tokens=False)
        of_b = self.b.encode([t for _, t in own], return_type="proto", num_threads=1)
        for (i, text), a, b in zip(own, of_a, of_b):
            raw, found_a = b" " + values[i], a.ids
            ids_b = [p.id for p in b.pieces]
            if b"".join(map(self.side_a.raw.__getitem__, found_a)) != raw:
                continue
            if b"".join(map(self.side_b.raw.__getitem__, ids_b)) != raw:
                continue
            ids_a, ids_b = np.array(found_a, np.int64), np.array(ids_b, np.int64)
            ends_a = np.fromiter((end for _, end in a.offsets), np.int64, len(ids_a))
            if len(text) + 1 != len(raw):
                ends_a = _byte_places(" " + text)[ends_a]
            ends_b = np.fromiter((p.end for p in b.pieces), np.int64, len(ids_b)) + 1  # the space in front
            out[i] = ids_a, refine(ends_a, self.side_a.size[ids_a]), ids_b, refine(ends_b, self.side_b.size[ids_b])
        return out


def _byte_places(text: str) -> np.ndarray:
    """The byte offset of each character, and of the end."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate(([0], np.cumsum(width)))


def refine(coarse: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from the ends of their coarse spans, which reach back to the
    end before: a span as long as its token's bytes stands, other tokens' lengths are
    added up from the last such end."""
    exact = np.diff(coarse, prepend=0) == size
    if exact.all():
        return coarse
    total = np.cumsum(size)
    last = np.maximum.accumulate(np.where(exact, np.arange(len(size)), -1))
    base = np.where(last >= 0, coarse[last] - total[last], 0)
    return base + total


@functools.lru_cache(maxsize=2)
def _loaded(key: int, shared) -> Pair:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
    return Pair(*shared.value)


class _Shared:
    """The tokenizer files as a broadcast, opened once a Python worker."""

    def __init__(self, spark: SparkSession, byte_bpe: str, piece_model: str) -> None:
        files = []
        for path in (byte_bpe, piece_model):
            with open(path, "rb") as f:
                files.append(f.read())
        self.shared = spark.sparkContext.broadcast(tuple(files))
        self.key = hash(tuple(files))

    def __hash__(self) -> int:
        return self.key

    def __eq__(self, other) -> bool:
        return self.key == other.key

    @property
    def value(self):
        return self.shared.value

    def pair(self) -> Pair:
        return _loaded(self.key, self)


def links(ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """A number ``id of A << 32 | id of B`` for every overlapping pair of tokens."""
    cuts = np.union1d(ends_a, ends_b)
    return ids_a[np.searchsorted(ends_a, cuts)] << 32 | ids_b[np.searchsorted(ends_b, cuts)]


def groups_words(ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray, pair: Pair) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3;``: the ids of each group, token by token."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    of_a, of_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    cut_a, cut_b = common[of_a] == ends_a, common[of_b] == ends_b
    upto_a, upto_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1  # tokens up to each group's end
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[np.arange(len(ids_a)) + np.concatenate(([0], upto_b))[of_a]] = 2 * ids_a + cut_a
    code[np.arange(len(ids_b)) + upto_a[of_b]] = 2 * len(pair.side_a.raw) + 2 * ids_b + cut_b
    return list(map(pair.written.__getitem__, code.tolist()))


def align_tokens(
    docs: DataFrame, key: str = "doc_id", text: str = "text", byte_bpe: str = BYTE_BPE_FILE, piece_model: str = PIECE_FILE
) -> DataFrame:
    """(key, a_ids, a_ends, b_ids, b_ends): the tokens and their byte ends in the space
    and the text; empty arrays without tokens."""
    shared = _Shared(docs.sparkSession, byte_bpe, piece_model)
    names = ["a_ids", "a_ends", "b_ids", "b_ends"]

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shared.pair()
        for batch in batches:
            values = texts(batch.column(1))
            for first, end in batches_by_bytes(values, _STRETCH):
                found = [x or ([], [], [], []) for x in pair.spans(values[first:end])]
                columns = [pa.array([x[i] for x in found], pa.list_(pa.int32())) for i in range(4)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), *columns], names=[key, *names])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(spans, f"`{key}` {kind}, " + ", ".join(f"{n} array<int>" for n in names))


_DOC = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_OWN = [("own", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))]
_BLOCK = [("pairs", pa.list_(pa.int64())), ("n_docs", pa.list_(pa.int32()))]
_BLOCK_DDL = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "own array<int>, times array<int>, pairs array<long>, n_docs array<int>"
)


class _Chunks:
    """The chunks a worker has seen, aligned and linked."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.pairs: dict[int, int] = {}  # pair of ids -> number
        self.clear()

    def clear(self) -> None:
        """Forgets the chunks; pairs keep their numbers."""
        self.number: dict[str, int] = {}
        self.text: list[bytes] = []  # the groups' ids
        self.counts = np.empty((4, 0), np.int64)  # of A, of B, groups, links; -1 where a token does not spell it
        self.start = np.zeros(1, np.int64)  # of a chunk's links
        self.links = np.empty(0, np.int64)  # numbers of pairs

    def numbers(self, values: np.ndarray) -> np.ndarray:
        get, pairs = self.pairs.setdefault, self.pairs
        return np.array([get(x, len(pairs)) for x in values.tolist()], np.int64)

    def learn(self, chunks: list[str]) -> None:
        """Adds chunks, none of them known or twice: joined by single spaces they are a
        text of just these chunks, and are tokenized as one."""
        plain = [c for c in chunks if c == c.strip()]
        groups = [plain[i : i + _JOINED] for i in range(0, len(plain), _JOINED)]
        parts = [p for group in groups for p in self._aligned(group)]
        parts += [p for c in chunks if c != c.strip() for p in self._aligned([c])]
        for names, written, _, _, _ in parts:
            for c, x in zip(names, written):
                self.number[c] = len(self.number)
                self.text.append(x)
        self.counts = np.concatenate((self.counts, *(p[2] for p in parts)), axis=1)
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(np.concatenate([p[3] for p in parts]))))
        self.links = np.concatenate((self.links, self.numbers(np.concatenate([p[4] for p in parts]))))

    def _aligned(self, chunks: list[str]) -> Iterator[tuple]:
        """(chunks, their groups' ids, their counts, numbers of links, links)."""
        (found,) = self.pair.spans([" ".join(chunks).encode()])
        if found is None:
            if len(chunks) > 1:  # one of them is not spelled by its tokens
                for c in chunks:
                    yield from self._aligned([c])
            else:
                yield chunks, [b""], np.full((4, 1), -1, np.int64), np.zeros(1, np.int64), np.empty(0, np.int64)
            return
        ids_a, ends_a, ids_b, ends_b = found
        last = np.cumsum([len(c.encode()) + 1 for c in chunks])  # the chunks' byte ends
        cuts = np.union1d(ends_a, ends_b)
        upto = [np.searchsorted(x, last, "right") for x in (ends_a, ends_b, cuts)]
        n_a, n_b, n = (np.diff(x, prepend=0) for x in upto)
        counts = np.stack((n_a, n_b, n_a + n_b - n, n))  # a shared end is one cut
        words, at = groups_words(ids_a, ends_a, ids_b, ends_b, self.pair), [0, *(upto[0] + upto[1]).tolist()]
        written = [b"".join(words[i:j]) for i, j in zip(at, at[1:])]
        yield chunks, written, counts, n, ids_a[np.searchsorted(ends_a, cuts)] << 32 | ids_b[np.searchsorted(ends_b, cuts)]

    def documents(self, values: list[bytes | None]) -> Iterator[tuple]:
        """For each text its row and its pairs' numbers and times."""
        none = (0, 0, 0, 0, ""), np.empty(0, np.int64), np.empty(0, np.int64)
        split = [_CUT.split(v.decode("utf-8", "replace")) if v and self.pair.cuts else None for v in values]
        known = self.number
        new = dict.fromkeys([c for parts in split if parts for c in parts if c not in known])
        if new:
            if len(self.number) + len(new) > _CHUNKS:
                self.clear()
                new = dict.fromkeys(c for parts in split if parts for c in parts)
            self.learn(list(new))
        for v, parts in zip(values, split):
            if not v:
                yield none
                continue
            if parts:
                of = np.array([self.number[c] for c in parts], np.int64)
                if (self.counts[0, of] >= 0).all():
                    row = [int(x) for x in self.counts[:, of].sum(axis=1)]
                    digest = hashlib.sha256(b"".join(map(self.text.__getitem__, of.tolist()))[:-1]).hexdigest()
                    own, times = np.unique(of, return_counts=True)
                    size = self.start[own + 1] - self.start[own]
                    skip = np.cumsum(size) - size
                    flat = self.links[np.repeat(self.start[own] - skip, size) + np.arange(int(size.sum()))]
                    pairs, place = np.unique(flat, return_inverse=True)
                    yield (*row, digest), pairs, np.bincount(place, np.repeat(times, size)).astype(np.int64)
                    continue
            (found,) = self.pair.spans([v])
            if found is None:
                yield none
                continue
            pairs, times = np.unique(self.numbers(links(*found)), return_counts=True)
            digest = hashlib.sha256(b"".join(groups_words(*found, self.pair))[:-1]).hexdigest()
            n_a, n_b, n = len(found[0]), len(found[2]), int(times.sum())
            yield (n_a, n_b, n_a + n_b - n, n, digest), pairs, times


class _Block:
    """The documents of a block and the pairs they hold."""

    def __init__(self, number: int, key_type: pa.DataType) -> None:
        self.number, self.key_type = number, key_type
        self.keys, self.rows, self.pairs, self.times, self.bytes = [], [], [], [], 0

    def add(self, key: pa.Scalar, found: tuple, size: int) -> None:
        row, pairs, times = found
        self.keys.append(key)
        self.rows.append(row)
        self.pairs.append(pairs.astype(np.int32))
        self.times.append(times.astype(np.int32))
        self.bytes += size

    def table(self, key: str, known: _Chunks) -> Iterator[pa.RecordBatch]:
        """The documents' rows, then one row with the block's pairs."""
        own, place, n_docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        pairs = np.fromiter(known.pairs, np.int64, len(known.pairs))[own]
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in self.pairs]))).astype(np.int32)
        n = len(self.rows)
        columns = [pa.array([self.number] * n, pa.int64()), pa.array(self.keys, self.key_type)]
        columns += [pa.array(x, t) for x, (_, t) in zip(zip(*self.rows), _DOC)]
        columns += [
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(x, pa.int32())) for x in (place, np.concatenate(self.times))
        ]
        columns += [pa.nulls(n, t) for _, t in _BLOCK]
        names = ["block", key, *(x for x, _ in _DOC + _OWN + _BLOCK)]
        rows = pa.RecordBatch.from_arrays(columns, names=names)
        for i in range(0, n, 1000):
            yield rows.slice(i, 1000)
        columns = [pa.array([self.number], pa.int64()), pa.nulls(1, self.key_type)]
        columns += [pa.nulls(1, t) for _, t in _DOC + _OWN]
        columns += [pa.array([x], t) for x, (_, t) in zip((pairs, n_docs), _BLOCK)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _block_rows(batches: Iterator[pa.RecordBatch], key: str, shared: _Shared, block_bytes: int) -> Iterator[pa.RecordBatch]:
    known, number, block = _Chunks(shared.pair()), TaskContext.get().partitionId() << 32, None
    for batch in batches:
        values, keys = texts(batch.column(1)), batch.column(0)
        for first, end in batches_by_bytes(values, _STRETCH):
            if block is None:
                block, number = _Block(number, keys.type), number + 1
            for i, found in enumerate(known.documents(values[first:end]), first):
                block.add(keys[i], found, len(values[i] or b""))
            if block.bytes >= block_bytes:
                yield from block.table(key, known)
                block = None
    if block is not None:
        yield from block.table(key, known)


def _scored(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows (block, kind, place, count, best, key, ...) sorted by the first three: a
    block's counts (kind 0), then its documents (kind 1), which get their sums."""
    at, counts, best, ready = None, [], [], None
    for batch in batches:
        block, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        edges = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
        for first, end in zip([0, *edges], [*edges, len(block)]):
            part = batch.slice(first, end - first)
            if block[first] != at:
                at, counts, best, ready = block[first], [], [], None
            if kind[first] == 0:
                counts.append(part.column(3).to_numpy(zero_copy_only=False))
                best.append(part.column(4).to_numpy(zero_copy_only=False))
                continue
            if ready is None:
                ready = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (counts, best)]
            own, times = (part.column(part.num_columns - i) for i in (2, 1))
            flat, n = own.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            bounds = np.concatenate(([0], np.cumsum(own.value_lengths().to_numpy())))
            sums = []
            for x in ready:
                total = np.concatenate(([0], np.cumsum(x[flat].astype(np.int64) * n)))
                sums.append(pa.array(total[bounds[1:]] - total[bounds[:-1]], pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[5:-2], sums[1], sums[0]], names=names)


def score_links(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    byte_bpe: str = BYTE_BPE_FILE,
    piece_model: str = PIECE_FILE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum): ``n_best``
    links have the highest corpus-wide count of their id of A; a pair's count is the
    number of documents that hold it linked."""
    spark = docs.sparkSession
    shared = _Shared(spark, byte_bpe, piece_model)
    kind = docs.schema[key].dataType.simpleString()
    found = docs.select(F.col(key).alias("key"), F.col(text)).mapInArrow(
        lambda b: _block_rows(b, "key", shared, block_bytes), f"block long, key {kind}, {_BLOCK_DDL}"
    )
    found = spill(found, "token-blocks")
    listed = found.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("place", "x"))
    listed = listed.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.n_docs").alias("n"))
    counts = spill(listed.groupBy("pair").agg(F.sum("n").alias("count")), "token-pairs")
    own = F.shiftright("pair", 32).alias("a")
    top = counts.groupBy(own).agg(F.max("count").alias("top"))  # at most a row for each id of A
    scored = counts.withColumn("a", own).join(F.broadcast(top), "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    doc_names = [n for n, _ in _DOC]
    no_doc = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("key", *doc_names, "own", "times")]
    back = listed.join(scored, "pair").select("block", F.lit(0).alias("kind"), "place", "count", F.col("best").cast("long"), *no_doc)
    none = F.lit(None).cast("long")
    rows = found.where("pairs is null").select(
        "block", F.lit(1).alias("kind"), F.lit(0).alias("place"), none.alias("count"), none.alias("best"), "key", *doc_names, "own", "times"
    )
    types = ", ".join(f"{n} {found.schema[n].dataType.simpleString()}" for n in doc_names)
    return (
        back.union(rows)
        .repartition("block")
        .sortWithinPartitions("block", "kind", "place")
        .mapInArrow(
            lambda b: _scored(b, [key, *doc_names, "n_best", "count_sum"]),
            f"`{key}` {kind}, {types}, n_best long, count_sum long",
        )
    )


def op13_tokenizer_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_links(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"),
    )
