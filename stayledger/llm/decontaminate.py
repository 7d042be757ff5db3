"""Benchmark decontamination with a generalised suffix automaton.

The test items' words form one automaton (a state for each class of substrings
that end at the same places in all items). Documents are streamed through it:
each word follows a transition or falls back over suffix links, which keeps the
length of the longest match that ends at this word. A window of ``window`` item
words (a whole item, where that is shorter) ends here if the match is at least
that long and the window's state lies on the suffix path; every word of it is
hit, and the window's items have occurred. Windows are attached to their states
when the automaton is built, so streaming is one step per word.

A document is contaminated when at least one in ``one_in`` of its words is hit. ``remove_contaminated`` drops such documents and cuts the hit spans out
of the others.

Scale: documents are never shuffled; the automaton is broadcast. Its size is
bounded by ``block_bytes`` of item text (1 MB takes some 230 MB in a Python worker), or
by one longer item: more items than that form several blocks of whole items, applied one after the other, each result
carried along as merged spans, with a checkpoint of (document key, spans)
between blocks. A text is streamed word by word, whatever its length.

Defined results: a null text has no words; items that are null or have no words
have no window; items with a null id mark words but are not counted or listed;
repeated items count once by id; an empty benchmark hits nothing; empty tables
stay empty. Columns of the input are kept; those named like an output are
replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.llm.frames import cut, table
from stayledger.llm.textbytes import FOLD_WORDS, texts

WINDOW = 13
ONE_IN = 20
BLOCK_BYTES = 1 << 20
_WORD = re.compile(rb"[^ ]+")

_FOUND = "struct<n_words:long,hits:array<struct<first:int,end:int>>,items:array<string>,rest:string>"
_FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
        ("rest", pa.string()),
    ]
)


def words_of(text: bytes | str | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(FOLD_WORDS).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with windows on states."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = []
        for item_id, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                coded.append((item_id, ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        #: state -> window length -> item ids
        self.windows: dict[int, dict[int, set]] = {}
        for item_id, ids in coded:
            n = min(window, len(ids))
            for state, _ in self._ends(ids, n):
                self.windows.setdefault(state, {}).setdefault(n, set()).add(item_id)
        self.shortest = min((n for by in self.windows.values() for n in by), default=0)
        # nearest state on the suffix path that holds a window, and the least match it needs
        self.near, self.need = [-1] * len(self.step), [1 << 30] * len(self.step)
        for v in sorted(range(len(self.step)), key=self.length.__getitem__):
            up = self.link[v]
            if up >= 0:
                self.near[v], self.need[v] = self.near[up], self.need[up]
            if v in self.windows:
                self.near[v], self.need[v] = v, min(self.need[v], min(self.windows[v]))

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """State for the strings of ``q`` that ``p`` extends by ``w``."""
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.step[last].get(w)
        if q is not None:  # another item already has this continuation
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _ends(self, ids: list[int], n: int) -> Iterator[tuple[int, int]]:
        """(state of the n words that end there, end) along a word sequence."""
        v = matched = 0
        for end, w in enumerate(ids, 1):
            while v and w not in self.step[v]:
                v = self.link[v]
                matched = self.length[v]
            if w in self.step[v]:
                v, matched = self.step[v][w], matched + 1
            if matched >= n:
                u = v
                while self.length[self.link[u]] >= n:
                    u = self.link[u]
                yield u, end

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged hit spans and the ids of the items whose windows occur."""
        if not self.shortest:
            return [], set()
        known = self.vocabulary.get
        ids = [known(w, 0) for w in words]
        spans: list[list[int]] = []
        items: set = set()
        step, link, length, need = self.step, self.link, self.length, self.need
        # a word no item has ends every match; shorter stretches hold no window
        at, total = 0, len(ids)
        while at < total:
            try:
                stop = ids.index(0, at)
            except ValueError:
                stop = total
            if stop - at >= self.shortest:
                v = matched = 0
                for end in range(at, stop):
                    w = ids[end]
                    while v and w not in step[v]:
                        v = link[v]
                        matched = length[v]
                    if w in step[v]:
                        v, matched = step[v][w], matched + 1
                    if need[v] <= matched:
                        self._mark(v, matched, end + 1, spans, items)
            at = stop + 1
        return _merged(spans), items

    def _mark(self, v: int, matched: int, end: int, spans: list, items: set) -> None:
        longest, u = 0, self.near[v]
        while u > 0:
            for n, ids in self.windows[u].items():
                if n <= matched:
                    longest = max(longest, n)
                    items |= ids
            u = self.near[self.link[u]]
        if longest:
            spans.append((end - longest, end))


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _rest(raw: bytes, hits: list[tuple[int, int]]) -> str:
    """The text without the hit words and what stands between them."""
    places = [m.span() for m in _WORD.finditer(raw.translate(FOLD_WORDS))]
    kept, at = [], 0
    for first, end in hits:
        kept.append(raw[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def _scanner(automaton, carried: bool, cut_texts: bool):
    """Arrow function text (, found in earlier blocks) -> found; ``cut_texts``: with
    the rest of a text that has hits."""

    def scan(column: pa.Array, earlier: pa.Array | None) -> pa.Array:
        found = automaton.value
        before = earlier.to_pylist() if earlier is not None else None
        rows = []
        for i, text in enumerate(texts(column)):
            words = words_of(text)
            hits, items = found.scan(words)
            if before is not None and before[i] is not None:
                hits = _merged(hits + [(h["first"], h["end"]) for h in before[i]["hits"]])
                items |= set(before[i]["items"])
            rows.append(
                {
                    "n_words": len(words),
                    "hits": [{"first": a, "end": b} for a, b in hits],
                    "items": sorted(x for x in items if x is not None),
                    "rest": _rest(text, hits) if cut_texts and hits else None,
                }
            )
        return pa.array(rows, _FOUND_ARROW)

    if carried:

        @F.arrow_udf(_FOUND)
        def with_earlier(column: pa.Array, earlier: pa.Array) -> pa.Array:
            return scan(column, earlier)

        return with_earlier

    @F.arrow_udf(_FOUND)
    def alone(column: pa.Array) -> pa.Array:
        return scan(column, None)

    return alone


def _blocks(items: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> Iterator[Automaton]:
    """Automata over blocks of whole items. Items fall into parts by their hash; neighbouring
    parts make a block as long as they have ``block_bytes`` of text together."""
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).where("text is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 64 * max(1, math.ceil(size / block_bytes))
    place = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
    own = rows.groupBy(place.alias("part")).agg(F.sum(F.octet_length("text")).alias("n"))
    sizes = sorted(map(tuple, own.collect()))  # 64 numbers a block
    first = 0
    while first < max(1, len(sizes)):
        end, total = first, 0
        while end < len(sizes) and (end == first or total + sizes[end][1] <= block_bytes):
            total, end = total + sizes[end][1], end + 1
        inside = place.between(sizes[first][0], sizes[end - 1][0]) if sizes else F.lit(False)
        block = rows.where(inside).collect()  # bounded by block_bytes, or one part
        yield Automaton([(r["id"], words_of(r["text"])) for r in block], window)
        first = max(end, first + 1)


def _found(
    docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, window: int, block_bytes: int, cut_texts: bool
) -> DataFrame:
    """Adds ``__found``, what the items' automata find in the text."""
    spark, found = docs.sparkSession, None
    for k, automaton in enumerate(_blocks(items, item_id, item_text, window, block_bytes)):
        shared = spark.sparkContext.broadcast(automaton)
        if k == 0:
            found = docs.withColumn("__found", _scanner(shared, False, cut_texts)(F.col(text)))
        else:  # executors hold one block's automaton at a time
            found = cut(found).withColumn("__found", _scanner(shared, True, cut_texts)(F.col(text), F.col("__found")))
    return found


def _n_hit() -> Column:
    return F.aggregate("__found.hits", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["first"])


def mark_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    one_in: int = ONE_IN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``hits`` (merged word spans, end exclusive),
    ``items`` (ids as strings, sorted) and ``contaminated``."""
    return (
        _found(docs, items, text, item_id, item_text, window, block_bytes, False)
        .withColumn("n_words", F.col("__found.n_words"))
        .withColumn("n_hit", _n_hit())
        .withColumn("hits", F.col("__found.hits"))
        .withColumn("items", F.col("__found.items"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))
        .drop("__found")
    )


def remove_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    one_in: int = ONE_IN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without contaminated documents, and without the hit words (and what
    stands between them) of the others; ``n_chars``, where present, follows the
    text. Same columns as ``docs``."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    found = _found(rows, items, "text", item_id, item_text, window, block_bytes, True)
    clean = (_n_hit() == 0) | (one_in * _n_hit() < F.col("__found.n_words"))
    rest, out = F.col("__found.rest"), []
    for c in docs.columns:
        value = F.col("row")[c]
        if c == text:
            value = F.coalesce(rest, value)
        elif c == "n_chars":
            value = F.coalesce(F.length(rest).cast(docs.schema[c].dataType), value)
        out.append(value.alias(c))
    return found.where(clean).select(*out)


def op2_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')" % (_UPPER, _LOWER)
)
OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS n, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS k
        FROM i WHERE len(w) > 0)
),
lens AS (SELECT DISTINCT n FROM win),
placed AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d JOIN lens ON len(w) >= n)
),
hit AS (SELECT doc_id, p.n, k, item_id FROM placed p JOIN win ON p.n = win.n AND p.s = win.s),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, n, k FROM hit)) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
