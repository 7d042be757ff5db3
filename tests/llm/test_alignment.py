"""Token alignment against a brute force that tries every pair of tokens byte by byte."""

import hashlib
import json
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from stayledger.llm import alignment as AL
from tests_llm_data import SMALL

COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def sides():
    """(ids and bytes of A, of B) of a text."""
    a = tokenizers.Tokenizer.from_file(AL.BYTE_BPE_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=AL.PIECE_FILE)
    with open(AL.BYTE_BPE_FILE, encoding="utf-8") as f:
        entry = {i: e for e, i in json.load(f)["model"]["vocab"].items()}
    back = {}
    odd = 0
    for x in range(256):  # the byte-level alphabet, as its public definition has it
        if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255:
            back[chr(x)] = x
        else:
            back[chr(256 + odd)] = x
            odd += 1

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if p.startswith("<0x") else p.replace("▁", " ").encode()

    def tokens(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return [(i, bytes(back[c] for c in entry[i])) for i in ids_a], [(i, of_b(i)) for i in ids_b]

    return tokens


def placed(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows, tokens):
    """Per row the contract's columns."""
    found, holders = [], Counter()
    for _, text in rows:
        if not text:
            found.append(None)
            continue
        a, b = tokens(text)
        raw = b" " + text.encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            found.append(None)
            continue
        a, b = placed(a), placed(b)
        pairs, first = [], 0
        for i, s, e in a:
            while b[first][2] <= s:
                first += 1
            for j, s2, e2 in b[first:]:
                if s2 >= e:
                    break
                pairs.append((i, j))
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, at = [], [0, 0]
        for cut in cuts:
            own = []
            for k, side in enumerate((a, b)):
                ids = []
                while at[k] < len(side) and side[at[k]][2] <= cut:
                    ids.append(str(side[at[k]][0]))
                    at[k] += 1
                own.append(",".join(ids))
            groups.append("|".join(own))
        holders.update(set(pairs))
        found.append((a, b, pairs, groups))
    top = {}
    for (i, j), n in holders.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for (key, _), x in zip(rows, found):
        if x is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, pairs, groups = x
            best = sum(holders[p] == top[p[0]] for p in pairs)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((key, len(a), len(b), len(groups), len(pairs), best, sum(holders[p] for p in pairs), digest))
    return Counter(out)


def test_query_equals_brute_force(spark, documents, sides):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = AL.op13_tokenizer_spans(spark, SMALL).select("doc_id", *COUNTS)
    assert got.dtypes == [("doc_id", "bigint"), *((c, "bigint") for c in COUNTS[:-1]), ("groups_sha256", "string")]
    assert Counter(map(tuple, got.collect())) == brute(rows, sides)


HARD = [
    "é中 a\U0001f600b \n<unk>x<|endoftext|>  z</s>",
    "\U0001f469‍\U0001f469‍\U0001f467 กำ   ꙮ \U00010348\U00010348",
    "a literal ▁ here",
    "tabs\t\tand\r\nlines\n\n\n  spaces   ",
    "\x00\x01\x7f",
    " ",
    "ﷺ ǅ ﬁ Å",
    "中文字符" * 30,
]


def test_multibyte_and_byte_fallback_tokens(spark, sides):
    rows = list(enumerate(HARD))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (1, 1 << 20):
        got = AL.score_links(df, block_bytes=block).select("doc_id", *COUNTS)
        assert Counter(map(tuple, got.collect())) == brute(rows, sides)
    spans = {r["doc_id"]: r for r in AL.align_tokens(df).collect()}
    for i, text in rows:
        if "▁" not in text:
            a, b = sides(text)
            assert spans[i]["a_ids"] == [x for x, _ in a] and spans[i]["b_ids"] == [x for x, _ in b]
            assert spans[i]["a_ends"] == np.cumsum([len(x) for _, x in a]).tolist()
            assert spans[i]["b_ends"] == np.cumsum([len(x) for _, x in b]).tolist()
    assert spans[2]["a_ids"] == [] and spans[2]["b_ends"] == []


def test_blocks_and_partitions_do_not_matter(spark, documents):
    docs = documents.select("doc_id", "text")
    expected = sorted(map(tuple, AL.score_links(docs).collect()))
    for n, block in ((1, 30_000), (7, 1), (3, 1 << 30)):
        assert sorted(map(tuple, AL.score_links(docs.repartition(n), block_bytes=block).collect())) == expected


def test_refine_adds_up_what_shares_a_character():
    # two whole tokens, a character of four bytes in two tokens, an empty span before a full one
    assert AL.refine(np.array([3, 5, 9, 9, 9, 11]), np.array([3, 2, 3, 1, 1, 1])).tolist() == [3, 5, 8, 9, 10, 11]
    assert AL.refine(np.array([4, 4, 6]), np.array([3, 1, 2])).tolist() == [3, 4, 6]


def test_chunks_equal_whole_texts(documents):
    """The sums of chunks against tokens of the whole text, also with odd white space."""
    pair = AL._Shared(documents.sparkSession, AL.BYTE_BPE_FILE, AL.PIECE_FILE).pair()
    assert pair.cuts
    texts = [r["text"].encode() for r in documents.select("text").collect() if r["text"]]
    texts += [x.encode() for x in HARD] + [b" lead", b"trail ", b"a  b   c", "a\u00a0 b \u2003c\n d".encode(), b"x\n\n y ", b"\n"]
    known = AL._Chunks(pair)
    for value, (row, pairs, times) in zip(texts, known.documents(texts)):
        (found,) = pair.spans([value])
        if found is None:
            assert row == (0, 0, 0, 0, "")
            continue
        n_a, n_b, n = len(found[0]), len(found[2]), len(AL.links(*found))
        digest = hashlib.sha256(b"".join(AL.groups_words(*found, pair))[:-1]).hexdigest()
        assert row == (n_a, n_b, n_a + n_b - n, n, digest)
        numbers = list(known.pairs)
        assert Counter(dict(zip([numbers[p] for p in pairs], times))) == Counter(AL.links(*found).tolist())


def test_edges(edge, empty, edge_rows, sides):
    rows = [(r[0], r[1]) for r in edge_rows]
    got = AL.score_links(edge).select("doc_id", *COUNTS).collect()
    assert Counter(map(tuple, got)) == brute(rows, sides)
    assert AL.score_links(empty).count() == 0 and AL.align_tokens(empty).count() == 0
    renamed = edge.withColumnRenamed("doc_id", "block").select("block", F.col("text").alias("pairs"))
    assert AL.score_links(renamed, "block", "pairs").count() == len(rows)
