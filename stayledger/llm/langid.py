"""Language ID: nearest of several centroids per language, by cosine.

A text's vector holds its byte bigrams and trigrams (ASCII letters folded, other
ASCII as spaces; UTF-8 bytes of other letters as they are), hashed to ``dims``
places, weighted log(1 + count) * idf and scaled to length 1. Each language's
sample vectors are clustered by spherical k-means into ``per_lang`` centroids,
as one language is written in several manners (prose, lists, tables). A text
gets the language of the nearest centroid; its score is that cosine. Each
language has a reach for texts of 16, 32, ... 4,096 bytes: ``slack`` times the
similarity to its own centroids that all but ``tail`` of such pieces of its sample
members have, as a short text shows few of its language's grams and lies far from any
centroid. Between these sizes the reach is interpolated, below 16 bytes it falls to
nothing. A text whose nearest centroid does not reach it is rejected, though it keeps
its prediction.

The fit takes about ``fit_rows`` labelled rows, split evenly over the labels, but some
``LEAST_ROWS`` of every label, chosen by a hash of id and text; whole texts are vectorised on
the executors, and only the sparse vectors of that sample are gathered. Prediction is an
Arrow function on the text column: no shuffle, and the model is the only thing shipped.
Labels whose centroids would take more than ``MAX_MODEL_BYTES`` raise a ValueError.

Defined results: a null text, or one without any letter, is ``und`` with score 0
and rejected; with no labelled row at all every text is; rows with a null label
are not learned from; repeated rows get equal predictions; ties go to the label
that sorts first; empty tables stay empty. Columns of the input are kept; those
named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.llm.frames import doc_key, table
from stayledger.llm.textbytes import batches_by_bytes, texts

MAX_MODEL_BYTES = 256 << 20
LEAST_ROWS = 20  # of a label, in the sample
PIECES = [16 << i for i in range(9)]  # bytes
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)
_CHUNK = 1 << 20


@dataclass
class Model:
    langs: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    reach: np.ndarray  # of each centroid, by ``PIECES``


def gram_counts(values: list[bytes | None], dims: int) -> np.ndarray:
    """Counts of hashed byte bigrams and trigrams, one row per text. Two spaces are
    put on either side of each text, so that no gram reaches from one text into
    the next; memory is bounded by ``_CHUNK`` bytes at a time."""
    counts = np.zeros(len(values) * dims, np.int64)
    shift = np.uint32(32 - dims.bit_length() + 1)
    padded = [b"  " + (v or b"").translate(_FOLD) + b"  " for v in values]
    ends = np.cumsum([len(p) for p in padded])
    joined = np.frombuffer(b"".join([*padded, b"  "]), np.uint8)
    for at in range(0, len(joined) - 2, _CHUNK):
        a = joined[at : at + _CHUNK + 2].astype(np.uint32)
        row = np.searchsorted(ends, np.arange(at, at + len(a) - 2), side="right") * dims
        two = a[:-2] << np.uint32(8) | a[1:-1]
        three = two << np.uint32(8) | a[2:]
        for code in (two + np.uint32(1 << 24), three):
            h = (code * np.uint32(2654435761)) ^ (code >> np.uint32(7))
            h = (h * np.uint32(2246822519)) >> shift
            np.add(counts, np.bincount(row + h, minlength=len(counts)), out=counts)
    return counts.reshape(len(values), dims)


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32)) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from the mean's farthest points."""
    centers = x.mean(0, keepdims=True)
    while len(centers) < min(k, len(x)):
        centers = np.vstack([centers, x[(x @ centers.T).max(1).argmin()]])
    for _ in range(rounds):
        owner = (x @ centers.T).argmax(1)
        sums = np.vstack([x[owner == c].sum(0) for c in range(len(centers)) if (owner == c).any()])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centers


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp(text, F.lit(r"\p{L}")), F.lit(False))


def fit(
    labelled: DataFrame,
    lang: str = "lang",
    text: str = "text",
    key: str = "doc_id",
    fit_rows: int = 2000,
    per_lang: int = 4,
    dims: int = 4096,
    slack: float = 0.5,
    tail: float = 0.05,
) -> Model:
    """Centroids from about ``fit_rows`` rows of ``labelled``."""
    rows = labelled.where(F.col(lang).isNotNull() & has_letter(F.col(text)))
    most = MAX_MODEL_BYTES // (4 * dims * per_lang)
    sizes = dict(rows.groupBy(lang).count().limit(most + 1).collect())
    if len(sizes) > most:
        raise ValueError(f"more than {most} different labels: the model would be over {MAX_MODEL_BYTES} bytes")
    each = max(LEAST_ROWS, fit_rows // max(1, len(sizes)))
    # a row is in the sample if its hash falls in its label's share
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, min(1.0, each / n)).otherwise(share)
    draw = F.shiftrightunsigned(doc_key(F.col(key), F.col(text)), 11) / float(1 << 53)

    @F.arrow_udf("struct<place:array<int>,n:array<int>>")
    def sparse(column: pa.Array) -> pa.Array:
        out = []
        for value in texts(column):
            c = gram_counts([value], dims)[0]
            out.append({"place": (p := np.flatnonzero(c)).astype(np.int32), "n": c[p].astype(np.int32)})
        return pa.array(out, pa.struct([("place", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]))

    sample = rows.where(draw < share).select(F.col(lang).alias("lang"), sparse(F.col(text)).alias("v"))
    got = sorted(((r["lang"], r["v"]["place"], r["v"]["n"]) for r in sample.collect()))
    counts = np.zeros((len(got), dims), np.int32)
    for row, (_, place, n) in zip(counts, got):
        row[place] = n
    idf = (np.log((1 + len(got)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    x = unit_rows(counts, idf)
    names = np.array([g[0] for g in got], dtype=object)
    langs, centroids = [], [np.zeros((0, dims), np.float32)]
    for name in sorted(set(names)):
        c = _clusters(x[names == name], per_lang)
        langs += [name] * len(c)
        centroids.append(c)
    model = Model(langs, np.vstack(centroids).astype(np.float32), idf, np.zeros((len(langs), len(PIECES)), np.float32))
    if langs:
        _set_reach(rows.where(draw < share).select(F.col(lang).alias("lang"), F.col(text).alias("text")), model, slack, tail)
    return model


def _set_reach(sample: DataFrame, model: Model, slack: float, tail: float) -> None:
    """Pieces from the middle of the sample's texts against their language's centroids."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<float>")
    def near(column: pa.Array, lang: pa.Array) -> pa.Array:
        m, out = shared.value, []
        own = {name: m.centroids[[x == name for x in m.langs]].T for name in set(m.langs)}
        for value, name in zip(texts(column), lang.to_pylist()):
            pieces = [value[(len(value) - n) // 2 :][:n] for n in PIECES if n <= len(value)]
            out.append((unit_rows(gram_counts(pieces, len(m.idf)), m.idf) @ own[name]).max(1).tolist() if pieces else [])
        return pa.array(out, pa.list_(pa.float32()))

    found: dict[str, list[list[float]]] = {}
    for name, values in sample.select("lang", near(F.col("text"), F.col("lang"))).collect():
        for of_size, v in zip(found.setdefault(name, [[] for _ in PIECES]), values):
            of_size.append(v)
    for i, name in enumerate(model.langs):
        last = 0.0
        for k, values in enumerate(found.get(name, [])):
            if values:
                last = slack * float(np.quantile(values, tail))
            model.reach[i, k] = last  # no member is that long: as before


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` (0 to 1) and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "struct<lang:string,score:double,rejected:boolean>"

    @F.arrow_udf(kind)
    def nearest(column: pa.Array, letters: pa.Array) -> pa.Array:
        m = shared.value
        values, n = texts(column), len(column)
        lang, score, rejected = ["und"] * n, np.zeros(n), np.ones(n, bool)
        rows = np.flatnonzero(letters.to_numpy(zero_copy_only=False)) if m.langs else np.empty(0, int)
        asked = [values[i] for i in rows]
        for first, end in batches_by_bytes(asked, _CHUNK, most=256):
            counts = gram_counts(asked[first:end], len(m.idf))
            near = unit_rows(counts, m.idf) @ m.centroids.T
            best, total = near.argmax(1), counts.sum(1)
            size = np.maximum(total / 2 - 2, 0) / PIECES[0]  # two grams a byte, and the spaces around
            at = np.clip(np.log2(np.maximum(size, 1)), 0, len(PIECES) - 1)
            low = np.minimum(at.astype(int), len(PIECES) - 2)
            least = m.reach[best, low] * (low + 1 - at) + m.reach[best, low + 1] * (at - low)
            least = least * np.minimum(size, 1)
            for i, b, s, r in zip(rows[first:end], best, near[np.arange(len(best)), best], least):
                lang[i], score[i], rejected[i] = m.langs[b], min(1.0, max(0.0, float(s))), s < r
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=["lang", "score", "rejected"]
        )

    return (
        docs.withColumn("__near", nearest(F.col(text), has_letter(F.col(text))))
        .withColumn("lang_pred", F.col("__near.lang"))
        .withColumn("score", F.col("__near.score"))
        .withColumn("rejected", F.col("__near.rejected"))
        .drop("__near")
    )


def held_out(doc_id: Column) -> Column:
    """Documents kept out of the fit: crc32 of the id as text, mod 4, is 2. A null
    id has no such remainder and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_documents(docs: DataFrame, **options) -> Model:
    """`fit` on the documents that are not held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))), **options)


def op1_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), fit_on_documents(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )
