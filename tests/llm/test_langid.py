import base64
import math
import random
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import langid as L
from tests_llm_data import SMALL, framed, prose


def test_held_out_documents_get_their_language(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = L.op1_nearest_centroid(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in {*lang.values(), "und"} and 0.0 <= r["score"] <= 1.0
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def slow_vector(raw, idf):
    """log(1 + count) * idf of the hashed byte bigrams and trigrams, one gram at a time."""
    dims, counts = len(idf), {}
    text = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in raw)
    padded = b"  " + text + b"  " + b"  "
    for i in range(len(text) + 4):
        two = padded[i] << 8 | padded[i + 1]
        for code in (two + (1 << 24), two << 8 | padded[i + 2]):
            h = (code * 2654435761 & 0xFFFFFFFF) ^ (code >> 7)
            h = (h * 2246822519 & 0xFFFFFFFF) >> (32 - dims.bit_length() + 1)
            counts[h] = counts.get(h, 0) + 1
    x = np.zeros(dims)
    for h, n in counts.items():
        x[h] = math.log1p(n) * idf[h]
    return x / np.linalg.norm(x), sum(counts.values())


def test_query_gives_the_nearest_centroid(spark, documents):
    """Every prediction, score and rejection of the query recomputed from the centroids."""
    m = L.fit_on_documents(documents)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    checked = 0
    for r in L.op1_nearest_centroid(spark, SMALL).collect():
        text = texts[r["doc_id"]]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        raw = text.encode()
        x, grams = slow_vector(raw, m.idf.astype(np.float64))
        near = m.centroids.astype(np.float64) @ x
        best = int(near.argmax())
        assert abs(near[best] - r["score"]) < 1e-4
        assert r["lang_pred"] in {m.langs[i] for i in np.flatnonzero(near > near[best] - 1e-5)}
        size = max(grams / 2 - 2, 0) / L.PIECES[0]
        at = min(max(math.log2(max(size, 1)), 0), len(L.PIECES) - 1)
        low = min(int(at), len(L.PIECES) - 2)
        least = (m.reach[best, low] * (low + 1 - at) + m.reach[best, low + 1] * (at - low)) * min(size, 1)
        assert abs(near[best] - least) < 1e-4 or r["rejected"] == (near[best] < least)
        checked += 1
    assert checked > 150


def test_rare_labels_keep_rows_in_the_sample(spark):
    rows = [(i, f"{prose(i, 30)}", "common", "s") for i in range(400)] + [(1000 + i, prose(9000 + i, 30), f"rare{i % 3}", "s") for i in range(30)]
    m = L.fit(framed(spark, rows), fit_rows=8, per_lang=2)
    assert set(m.langs) == {"common", "rare0", "rare1", "rare2"}
    many = spark.range(50_000).selectExpr("id as doc_id", "concat('text ', id) as text", "concat('l', id) as lang")
    with pytest.raises(ValueError, match="labels"):
        L.fit(many)


def test_held_out_labels_are_not_learned(spark, documents):
    spoiled = documents.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    a, b = L.fit_on_documents(documents), L.fit_on_documents(spoiled)
    assert a.langs == b.langs and np.array_equal(a.centroids, b.centroids)


def test_several_unit_centroids_per_language(spark, documents):
    m = L.fit_on_documents(documents, per_lang=3)
    assert {x: m.langs.count(x) for x in m.langs} == {"de": 3, "en": 3, "es": 3, "fr": 3}
    assert np.allclose(np.linalg.norm(m.centroids, axis=1), 1, atol=1e-4)


def test_counts_are_the_same_in_parts_and_for_long_texts(monkeypatch):
    texts = [b"abc", None, b"", "déjà vu ".encode() * 40, b"A1b2 " * 500]
    whole = L.gram_counts(texts, 512)
    monkeypatch.setattr(L, "_CHUNK", 64)
    assert np.array_equal(whole, L.gram_counts(texts, 512))
    assert np.array_equal(whole, np.vstack([L.gram_counts([t], 512) for t in texts]))


def test_rejection_by_distance(spark, documents):
    m = L.fit_on_documents(documents)
    rows = [
        (1, "Это предложение написано на языке, которого в обучении не было, и довольно длинное.", None, None),
        (2, "这是一段中文文本，模型从来没有见过这种语言。", None, None),
        (3, "12 34 -- !!", None, None),
        (4, "the of and", None, None),
    ]
    got = {r["doc_id"]: r for r in L.predict(framed(spark, rows), m).collect()}
    assert got[1]["rejected"] and got[2]["rejected"] and not got[4]["rejected"]
    assert (got[3]["lang_pred"], got[3]["score"], got[3]["rejected"]) == ("und", 0.0, True)
    assert got[4]["lang_pred"] == "en"
    clean = L.predict(documents, m)
    assert clean.where("rejected").count() == 0


def test_texts_of_no_learned_language_are_rejected(spark, documents):
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice(string.ascii_letters) for _ in range(n))
    code = lambda n: base64.b64encode(rng.randbytes(n * 3 // 4)).decode()
    foreign = [
        "Ten dokument został napisany w języku, którego model nigdy wcześniej nie widział, i jest dość długi.",
        "Tämä asiakirja on kirjoitettu kielellä, jota malli ei ole koskaan ennen nähnyt, ja se on melko pitkä.",
        "Bu belge, modelin daha önce hiç görmediği bir dilde yazılmıştır ve oldukça uzundur.",
    ]
    alien = [*foreign, *(f(n) for f in (letters, code) for n in (100, 1000, 5000))]
    m = L.fit_on_documents(documents)
    got = L.predict(framed(spark, [(i, t, None, None) for i, t in enumerate(alien)]), m).collect()
    assert all(r["rejected"] for r in got), [(r["doc_id"], r["score"]) for r in got if not r["rejected"]]
    held = [r["text"].encode() for r in documents.where(L.held_out(F.col("doc_id"))).collect()]
    short = [t[at : at + n].decode(errors="ignore") for t in held for n in (24, 48, 100, 300) for at in range(0, min(len(t) - n, 900), 300)]
    rows = L.predict(framed(spark, [(i, t, None, None) for i, t in enumerate(short)]), m).collect()
    assert sum(r["rejected"] for r in rows) <= 0.02 * len(rows) and len(rows) > 300, (sum(r["rejected"] for r in rows), len(rows))


@pytest.mark.parametrize("lang", ["de", "en", "es", "fr"])
def test_a_language_left_out_of_the_fit_is_rejected(spark, lang):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = L.fit_on_documents(docs.where(F.col("lang") != lang))
    out = L.predict(docs, m).groupBy((F.col("lang") == lang).alias("alien")).agg(F.avg(F.col("rejected").cast("int")), F.count(F.lit(1)))
    rate = {r[0]: r[1] for r in out.collect()}
    print(lang, "rejected of its documents, of others:", rate[True], rate[False])
    assert rate[True] >= 0.9 and rate[False] <= 0.01


def test_edges(spark, documents, edge, empty):
    m = L.fit_on_documents(documents)
    out = L.predict(edge, m)
    assert out.count() == edge.count() and set(edge.columns) <= set(out.columns)
    und = sorted(str(r["text"]) for r in out.where("lang_pred = 'und'").collect())
    assert und == sorted(["None", "None", "", " \t\n \r\n", "1234 5678 !!"])
    same = {(r["lang_pred"], r["score"]) for r in out.where("doc_id = 4").collect()}
    assert len(same) == 1
    assert L.predict(empty, m).count() == 0
    nothing = L.fit_on_documents(empty)
    assert L.predict(edge, nothing).where("lang_pred <> 'und' or not rejected").count() == 0
