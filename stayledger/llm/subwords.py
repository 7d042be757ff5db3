"""SentencePiece encoding and decoding with distinct sampled segmentations.

Encoding. A space becomes ``▁``, one ``▁`` is put in front, and characters that no
piece holds (also a literal ``▁`` and the newline) become the pieces of their
UTF-8 bytes. The lattice of a text holds every way to cut it into pieces; a
segmentation's weight is the product of its pieces' probabilities. The model
file ranks its pieces by merge order, not by probability, so piece r has
probability 1 / (r + 2.7), normalised: Zipf's law with Mandelbrot's shift. Weights
are raised to ``alpha`` (1: as they are, 0: all segmentations alike) and scaled to
sum to 1 over a text's segmentations.
Decoding joins the pieces' bytes and drops the ``▁`` in front: exact for every text.

Sampling. ``k`` different segmentations are drawn without replacement by Gumbel
top-k, as a best-first (A*) search over perturbed scores. A set of segmentations
carries the maximum of its members' perturbed log-probabilities, whose
distribution follows from the set's total probability (the forward sums of the
lattice, an exact bound). The search pops the set with the largest maximum, draws
the segmentation that attains it, and splits the rest of the set into the sets
"the same up to chunk i, another cut of chunk i, anything after", each with a
Gumbel truncated at the popped value. No set is expanded before it is popped, so
k pops give k segmentations. The value left on top after them is the threshold
kappa, and exp(log_prob) enters the sample with probability
1 - exp(-exp(log_prob - kappa)): its inclusion score, given as a logarithm, as a
long text's segmentations are all improbable.

No piece crosses from a word into a following ``▁``, so the lattice is a chain of
chunks (a word with the ``▁`` before it; a run of byte pieces) whose cuts are
independent. Forward sums are made once per different chunk of a few MB of
text, and all documents of that stretch are walked together, in NumPy. Random
numbers are a hash of (row key, sample, chunk, step): the same row gives the same
samples on any cluster. Documents are never shuffled.

Defined results: a null text gives one row, sample 0, without ids; an empty text
has one, empty, segmentation; a text with fewer than k segmentations gives all
of them, with log_inclusion 0; repeated rows give equal samples; an empty table
gives no rows; columns other than the key and the text are not carried along.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.llm.frames import table
from stayledger.llm.textbytes import batches_by_bytes, texts

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
ALPHA = 0.5
_DENSE = 256  # ASCII and Latin letters
_BYTE = 0xF0000  # private-use code points that stand for byte pieces
_STRETCH = 512 << 10  # the arrays over a stretch stay within 100 MB
_LINEAR = 96  # chunks up to this length are summed as plain numbers, longer ones as logarithms


@dataclass
class Pieces:
    """The lattice's vocabulary: a hashed trie, log-probabilities, decoding bytes."""

    number: np.ndarray  # code point -> number of the character, 0 for what no piece holds
    root: np.ndarray  # number of a character -> its trie node under the root, or 0
    two: np.ndarray  # the same for two characters, both of the first ``_DENSE`` numbers
    slots: np.ndarray  # hashed (node, character number)
    child: np.ndarray
    piece: np.ndarray  # trie node -> piece id, or -1
    log_p: np.ndarray  # by id
    byte_id: np.ndarray  # byte -> id
    bytes_of: list[bytes]
    known: str  # regex class body of the characters that pieces hold
    tall: float  # per character, added to log weights so that plain sums keep within range


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def load_pieces(model: bytes, alpha: float = ALPHA) -> Pieces:
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    text = {i: sp.id_to_piece(i) for i in plain}
    chars = np.array(sorted({ord(c) for p in text.values() for c in p}), np.int64)
    number = {int(c): i + 1 for i, c in enumerate(chars)}
    log_p = np.full(n, -np.inf)
    weight = 1.0 / (np.arange(1, len(plain) + 1) + 2.7)
    log_p[plain] = np.log(weight)
    byte_id = np.zeros(256, np.int32)
    bytes_of = [b""] * n
    for i in range(n):
        if sp.is_byte(i):
            b = int(sp.id_to_piece(i)[3:5], 16)
            byte_id[b], bytes_of[i], log_p[i] = i, bytes([b]), np.log(weight[-1])
    log_p -= np.log(np.exp(log_p).sum())
    nodes: dict[tuple[int, int], int] = {}
    piece = [-1]
    for i, p in text.items():
        at = 0
        for c in p:
            step = (at, number[ord(c)])
            if step not in nodes:
                nodes[step] = len(piece)
                piece.append(-1)
            at = nodes[step]
        piece[at] = i
        bytes_of[i] = p.replace(SPACE, " ").encode()
    size = 1 << (len(nodes) * 4).bit_length()
    slots, child = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    for (at, c), to in nodes.items():
        key = at << 16 | c
        s = int(_slot(np.array([key]), size)[0])
        while slots[s] >= 0:
            s = (s + 1) % size
        slots[s], child[s] = key, to
    known = "".join(re.escape(chr(c)) for c in chars if chr(c) != SPACE) + r"\x20\n"
    number_of = np.zeros(0x110000, np.uint16)
    number_of[chars] = np.arange(1, len(chars) + 1)
    root = np.zeros(len(chars) + 1, np.int32)
    for (at, c), to in nodes.items():
        if at == 0:
            root[c] = to
    two = np.zeros((_DENSE, _DENSE), np.int32)
    first = {to: c for (at, c), to in nodes.items() if at == 0 and c < _DENSE}
    for (at, c), to in nodes.items():
        if at in first and c < _DENSE:
            two[first[at], c] = to
    return Pieces(
        number_of, root, two, slots, child, np.array(piece, np.int32), alpha * log_p, byte_id, bytes_of, known, 4.0 * alpha
    )


@functools.lru_cache(maxsize=4)
def _patterns(known: str) -> tuple[re.Pattern, re.Pattern]:
    low, high = chr(_BYTE), chr(_BYTE + 255)
    return re.compile(f"[^{known}]"), re.compile(f"{SPACE}*[^{SPACE}{low}-{high}]+|{SPACE}+|[{low}-{high}]+")


def chunks_of(text: str, p: Pieces) -> list[str]:
    if not text:
        return []
    strange, chunk = _patterns(p.known)
    raw = strange.sub(lambda m: "".join(chr(_BYTE + b) for b in m[0].encode()), text)
    raw = raw.replace(" ", SPACE).replace("\n", chr(_BYTE + 10))
    return chunk.findall(SPACE + raw)


def decode_ids(ids: list[int], p: Pieces) -> str:
    return b"".join(map(p.bytes_of.__getitem__, ids))[1:].decode("utf-8", "replace")


class Lattices:
    """The lattices of many chunks: node j of chunk t stands before its unit j;
    edges are listed by the node they end at, with the probability of being the
    last piece of a random segmentation up to there."""

    def __init__(self, chunks: list[str], p: Pieces) -> None:
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        self.base = np.concatenate(([0], np.cumsum(size + 1)))[:-1]  # node of the chunk's start
        self.end = self.base + size
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        n_nodes = int(size.sum()) + len(chunks)
        # a unit sits at the node before it; the last node of a chunk has none
        at = np.arange(len(points)) + np.repeat(np.arange(len(chunks)), size)
        unit = np.zeros(n_nodes, np.int64)
        unit[at] = p.number[points]
        depth = np.arange(n_nodes) - np.repeat(self.base, size + 1)  # units before the node
        found = []  # (length, nodes where the edges start, piece ids)
        node = p.root[unit[at]].astype(np.int64)
        live = at[node > 0]
        node, length = node[node > 0], 1
        while len(live):
            if length > 1:
                c = unit[live + length - 1]
                if length == 2:
                    a = unit[live]
                    dense = (a < _DENSE) & (c < _DENSE)
                    to = np.where(dense, p.two[np.where(dense, a, 0), np.where(dense, c, 0)], 0).astype(np.int64)
                    if not dense.all():
                        to[~dense] = self._step(node[~dense], c[~dense], p)
                else:
                    to = self._step(node, c, p)
                live, node = live[to > 0], to[to > 0]
            ids = p.piece[node]
            piece = ids >= 0
            if piece.any():
                found.append((length, live[piece], ids[piece]))
            length += 1
        # what has no piece of its own: byte units (characters only come with one)
        byte = at[(points >= _BYTE) & (points < _BYTE + 256)]
        own = p.byte_id[points[(points >= _BYTE) & (points < _BYTE + 256)] - _BYTE]
        if len(byte):
            found.insert(0, (1, byte, own))
        self._sum(found, n_nodes, depth, np.repeat(size > _LINEAR, size + 1), p)

    @staticmethod
    def _step(node: np.ndarray, c: np.ndarray, p: Pieces) -> np.ndarray:
        """The trie nodes one character on, 0 where there is none."""
        to = np.zeros(len(node), np.int64)
        ask = np.flatnonzero(c)
        key = node[ask] << 16 | c[ask]
        slot = _slot(key, len(p.slots))
        while len(ask):
            held = p.slots[slot]
            same = held == key
            to[ask[same]] = p.child[slot[same]]
            more = np.flatnonzero((held >= 0) & ~same)
            ask, key, slot = ask[more], key[more], (slot[more] + 1) % len(p.slots)
        return to

    def _sum(self, found: list, n_nodes: int, depth: np.ndarray, long: np.ndarray, p: Pieces) -> None:
        edges = []  # of one length each: start, piece, log weight, weight; by the depth they end at
        for length, start, ids in found:
            d = depth[start] + length
            order = np.argsort(d if d.max() >= 1 << 15 else d.astype(np.int16), kind="stable")
            bounds = np.bincount(d).cumsum()  # edges that end at depth d or before
            start, ids = start[order], ids[order]
            w = p.log_p[ids]
            edges.append((length, start, ids, w, np.exp(w + p.tall * length), [0, *bounds.tolist()]))
        deepest = max((len(e[5]) - 2 for e in edges), default=0)
        total = np.where(long, -np.inf, 0.0)
        total[depth == 0] = np.where(long[depth == 0], 0.0, 1.0)
        any_long = bool(long.any())
        for d in range(1, deepest + 1):
            for length, start, _, log_w, w, bounds in edges:
                if d + 1 < len(bounds) and bounds[d] < bounds[d + 1]:
                    here = slice(bounds[d], bounds[d + 1])
                    s, v = start[here], w[here]
                    if any_long and (log := long[s]).any():
                        a = s[log]
                        total[a + length] = np.logaddexp(total[a + length], total[a] + log_w[here][log])
                        s, v = s[~log], v[~log]
                    total[s + length] += total[s] * v
        degree = np.zeros(n_nodes, np.int64)
        for length, start, *_ in edges:
            degree[start + length] += 1
        self.first = np.concatenate(([0], np.cumsum(degree)))[:-1]
        n = int(degree.sum())
        self.prev, self.id, self.p = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n)
        self.below, fill = np.zeros(n), self.first.copy()
        seen = np.zeros(n_nodes)
        for length, start, ids, log_w, w, _ in edges:
            end = start + length
            at = fill[end]
            fill[end] += 1
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                prob = total[start] * w / total[end]
                if any_long:
                    prob = np.where(long[start], np.exp(total[start] + log_w - total[end]), prob)
            seen[end] += prob
            self.prev[at], self.id[at], self.below[at], self.p[at] = start, ids, seen[end], prob
        last = self.first + degree - 1
        self.below[last[degree > 0]] = np.inf  # rounding never runs past the last edge
        self.degree = degree


_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seed: np.ndarray, step: int) -> np.ndarray:
    """In (0, 1), by seed and step."""
    x = (seed + np.uint64((step * 0xD1342543DE82EF95 + 1) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _gumbel(seed: np.ndarray, step: int) -> np.ndarray:
    return -np.log(-np.log(_uniform(seed, step)))


class _Pool:
    """Cuts of chunk occurrences: piece ids end to end; a cut is (place, length)."""

    def __init__(self) -> None:
        self.parts, self.size = [], 0

    def add(self, ids: np.ndarray) -> int:
        self.parts.append(ids)
        self.size += len(ids)
        return self.size - len(ids)


def _draw(lat: Lattices, chunk: np.ndarray, seed: np.ndarray, pool: _Pool):
    """A random cut of each chunk occurrence: (place, length, log-probability)."""
    cur, goal = lat.end[chunk].copy(), lat.base[chunk]
    log_p, length = np.zeros(len(chunk)), np.zeros(len(chunk), np.int64)
    live, steps = np.arange(len(chunk)), []
    step = 0
    while len(live):
        u = _uniform(seed[live], step)
        edge = lat.first[cur[live]]
        over = np.flatnonzero(u > lat.below[edge])
        while len(over):
            edge[over] += 1
            over = over[u[over] > lat.below[edge[over]]]
        steps.append((live, lat.id[edge]))
        log_p[live] += np.log(lat.p[edge])
        length[live] += 1
        cur[live] = lat.prev[edge]
        live = live[cur[live] != goal[live]]
        step += 1
    place = np.concatenate(([0], np.cumsum(length)))[:-1]
    ids, left = np.zeros(int(length.sum()), np.int32), place + length
    for who, piece in steps:  # drawn from the end
        left[who] -= 1
        ids[left[who]] = piece
    return place + pool.add(ids), length, log_p


def _draw_other(lat: Lattices, chunk: int, taken: list[list[int]], seed: np.ndarray) -> tuple[list[int], float]:
    """A random cut of one chunk, other than those ``taken``."""
    cur, goal, out, log_p, step = int(lat.end[chunk]), int(lat.base[chunk]), [], 0.0, 0
    open_ = []  # (pieces still to come, from the end; their probability from here)
    for cut in taken:
        prob, at = 1.0, cur
        for i in reversed(cut):
            e = next(e for e in range(lat.first[at], lat.first[at] + lat.degree[at]) if lat.id[e] == i)
            prob, at = prob * float(lat.p[e]), int(lat.prev[e])
        open_.append((cut, prob))
    while cur != goal:
        edges = range(int(lat.first[cur]), int(lat.first[cur] + lat.degree[cur]))
        prob = [float(lat.p[e]) for e in edges]
        mass = [max(0.0, q - sum(r for c, r in open_ if c[-1] == lat.id[e])) for e, q in zip(edges, prob)]
        u, k = float(_uniform(seed, step)[0]) * sum(mass), 0
        while k + 1 < len(mass) and (u > mass[k] or mass[k] == 0.0):
            u -= mass[k]
            k += 1
        while mass[k] == 0.0 and k:
            k -= 1
        e = edges[k]
        open_ = [(c[:-1], r / prob[k]) for c, r in open_ if c[-1] == lat.id[e]]
        out.append(int(lat.id[e]))
        log_p += float(np.log(lat.p[e]))
        cur = int(lat.prev[e])
        step += 1
    return out[::-1], log_p


def sample_segmentations(values: list[str], keys: np.ndarray, k: int, p: Pieces):
    """For each text a list of up to ``k`` (ids, log_prob, log_inclusion), in the order
    drawn. ``keys``: a 64-bit row key for each text."""
    rows = [chunks_of(v, p) for v in values]
    out: list[list] = [[] if r else [(np.empty(0, np.int32), 0.0, 0.0)] for r in rows]
    docs = [i for i, r in enumerate(rows) if r]
    if not docs:
        return out
    number: defaultdict[str, int] = defaultdict(count().__next__)  # a new chunk gets the next number
    n = np.array([len(rows[i]) for i in docs])
    chunk = np.fromiter(map(number.__getitem__, chain.from_iterable(rows)), np.int64, int(n.sum()))
    lat = Lattices(list(number), p)
    start = np.concatenate(([0], np.cumsum(n)))
    doc = np.repeat(np.arange(len(docs)), n)
    nth = np.arange(len(chunk)) - start[doc]
    key = _mix(np.asarray(keys, np.uint64)[docs] + _GOLD)

    def seeds(sample: int, at: np.ndarray, purpose: int) -> np.ndarray:
        salt = np.uint64((sample * 4 + purpose) * 0xA0761D6478BD642F & (2**64 - 1))
        return _mix((key[doc[at]] ^ salt) + nth[at].astype(np.uint64) * _GOLD)

    pool = _Pool()
    everywhere = np.arange(len(chunk))
    samples = []  # of each: place, length, log_p by chunk occurrence
    sets = []  # of each: value of the set that leaves the sample at this chunk
    taken: dict[tuple[int, int, int], list] = {}  # (sample, doc, chunk) -> cuts ruled out, where more than the sample's own
    best = -np.log(-np.log(_uniform(key, 0)))  # the maximum over all segmentations
    alive = np.ones(len(docs), bool)
    values_of = []

    def cut(sample: int, at: int) -> list[int]:
        place, length, _ = samples[sample]
        return flat[place[at] : place[at] + length[at]].tolist()

    for s in range(k):
        if s == 0:
            here = (*_draw(lat, chunk, seeds(0, everywhere, 1), pool),)
            fresh = np.ones(len(chunk), bool)
        else:
            tops = np.array([np.maximum.reduceat(v, start[:-1]) for v in sets])
            base, best = tops.argmax(0), tops.max(0)
            alive = best > -np.inf
            here = tuple(np.zeros(len(chunk), t) for t in (np.int64, np.int64, np.float64))
            fresh, flat = np.zeros(len(chunk), bool), np.concatenate(pool.parts)
            pool.parts = [flat]
            for d in np.flatnonzero(alive):
                b, a, z = int(base[d]), start[d], start[d + 1]
                i = a + int(sets[b][a:z].argmax())
                sets[b][i] = -np.inf  # popped
                for mine, theirs in zip(here, samples[b]):
                    mine[a:i] = theirs[a:i]
                out_of = taken.get((b, d, i - a)) or [cut(b, i)]
                ids, log_p = _draw_other(lat, int(chunk[i]), out_of, seeds(s, np.array([i]), 2))
                here[0][i], here[1][i], here[2][i] = pool.add(np.array(ids, np.int32)), len(ids), log_p
                taken[s, d, i - a] = [*out_of, ids]
                fresh[i + 1 : z] = True
            at = np.flatnonzero(fresh)
            if len(at):
                for mine, drawn in zip(here, _draw(lat, chunk[at], seeds(s, at, 1), pool)):
                    mine[at] = drawn
        samples.append(here)
        values_of.append((best, alive))
        # split what is left of the popped set
        log_p = here[2]
        before = np.cumsum(log_p) - log_p
        before -= before[start[:-1]][doc]
        with np.errstate(divide="ignore"):
            rest = np.log(-np.expm1(np.minimum(log_p, 0.0)))
        value = np.full(len(chunk), -np.inf)
        open_ = fresh & alive[doc]
        if s:
            for (ts, d, i), cuts in taken.items():
                if ts == s:  # the popped chunk itself: all cuts drawn so far are ruled out
                    at_ = start[d] + i
                    gone = _probability(lat, int(chunk[at_]), cuts)
                    rest[at_] = np.log1p(-gone) if gone < 1 - 1e-12 else -np.inf
                    open_[at_] = True
        at = np.flatnonzero(open_ & (rest > -np.inf))
        g = before[at] + rest[at] + _gumbel(seeds(s, at, 3), 0)
        value[at] = -np.logaddexp(-best[doc[at]], -g)
        sets.append(value)
    flat = np.concatenate(pool.parts)
    kappa = np.array([np.maximum.reduceat(v, start[:-1]) for v in sets]).max(0)
    for (place, length, log_p), (_, alive) in zip(samples, values_of):
        for j, d in enumerate(docs):
            if alive[j]:
                a, z = start[j], start[j + 1]
                size = length[a:z]
                skip = np.cumsum(size) - size
                ids = flat[np.repeat(place[a:z] - skip, size) + np.arange(int(size.sum()))]
                lp = min(0.0, float(log_p[a:z].sum()))
                out[d].append((ids, lp, _log_inclusion(lp - float(kappa[j]))))
    return out


def _log_inclusion(above: float) -> float:
    """log(1 - exp(-exp(above))); for far-off values, where that underflows, its limit."""
    if above < -30.0:
        return above
    return float(np.log(-np.expm1(-np.exp(min(above, 700.0)))))


def _probability(lat: Lattices, chunk: int, cuts: list[list[int]]) -> float:
    total = 0.0
    for cut in cuts:
        prob, at = 1.0, int(lat.end[chunk])
        for i in reversed(cut):
            e = next(e for e in range(lat.first[at], lat.first[at] + lat.degree[at]) if lat.id[e] == i)
            prob, at = prob * float(lat.p[e]), int(lat.prev[e])
        total += prob
    return total


def _shared_pieces(spark: SparkSession, model_file: str, alpha: float = ALPHA):
    with open(model_file, "rb") as f:
        return spark.sparkContext.broadcast(load_pieces(f.read(), alpha))


def encode_samples(
    docs: DataFrame,
    k: int = 2,
    key: str = "doc_id",
    text: str = "text",
    model_file: str = MODEL_FILE,
    alpha: float = ALPHA,
) -> DataFrame:
    """(key, sample from 0, ids, log_prob, log_inclusion): ``k`` rows for a text that
    has as many segmentations."""
    pieces = _shared_pieces(docs.sparkSession, model_file, alpha)
    key_type = docs.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ids = texts(batch.column(1)), batch.column(0)
            seeds = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            for first, end in batches_by_bytes(raw, _STRETCH):
                own = [i for i in range(first, end) if raw[i] is not None]
                found = sample_segmentations([raw[i].decode() for i in own], seeds[own], k, pieces.value)
                rows = [(i, s, *x) for i, xs in zip(own, found) for s, x in enumerate(xs)]
                rows += [(i, 0, None, None, None) for i in range(first, end) if raw[i] is None]
                bounds = np.concatenate(([0], np.cumsum([0 if r[2] is None else len(r[2]) for r in rows]))).astype(np.int32)
                flat = np.concatenate([r[2] for r in rows if r[2] is not None] or [np.empty(0, np.int32)])
                gone = pa.array([r[2] is None for r in rows], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([r[0] for r in rows], pa.int64())),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.int32()), mask=gone),
                        pa.array([r[3] for r in rows], pa.float64()),
                        pa.array([r[4] for r in rows], pa.float64()),
                    ],
                    names=[key, "sample", "ids", "log_prob", "log_inclusion"],
                )

    rows = docs.select(F.col(key), F.col(text), F.xxhash64(F.col(key).cast("string")).alias("_seed"))
    return rows.mapInArrow(
        encode, f"`{key}` {key_type}, sample int, ids array<int>, log_prob double, log_inclusion double"
    )


def decode(spark: SparkSession, ids: Column, model_file: str = MODEL_FILE) -> Column:
    """The text of an array of piece ids (null for null)."""
    pieces = _shared_pieces(spark, model_file)

    @F.arrow_udf("string")
    def joined(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else decode_ids(x, pieces.value) for x in column.to_pylist()], pa.string())

    return joined(ids)


def op7_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_samples(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), "log_prob", "log_inclusion", "ids"
    )
