import itertools
import math

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayledger.llm import subwords as W
from tests_llm_data import SMALL, framed, prose


@pytest.fixture(scope="module")
def pieces():
    with open(W.MODEL_FILE, "rb") as f:
        return W.load_pieces(f.read())


def cuts(chunk, ids):
    """Every segmentation of a chunk, as id lists (byte pieces for what has none)."""
    if not chunk:
        yield []
        return
    if ord(chunk[0]) >= W._BYTE:
        for rest in cuts(chunk[1:], ids):
            yield [ids[ord(chunk[0]) - W._BYTE], *rest]
        return
    for j in range(1, min(16, len(chunk)) + 1):
        if chunk[:j] in ids:
            for rest in cuts(chunk[j:], ids):
                yield [ids[chunk[:j]], *rest]


@pytest.fixture(scope="module")
def id_of(pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=W.MODEL_FILE)
    out = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not sp.is_byte(i) and not sp.is_control(i) and not sp.is_unknown(i)}
    return out | {b: int(i) for b, i in enumerate(pieces.byte_id)}


def distribution(text, pieces, id_of):
    every = [tuple(sum(x, [])) for x in itertools.product(*[list(cuts(c, id_of)) for c in W.chunks_of(text, pieces)])]
    w = np.exp([sum(pieces.log_p[i] for i in s) for s in every])
    return dict(zip(every, w / w.sum()))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from([" ", "the ", "▁", "\n\n", "ing", chr(W._BYTE + 3)])), max_size=8).map("".join))
def test_round_trip_of_any_text(pieces, text):
    text = text.encode("utf-8", "ignore").decode()
    got = W.sample_segmentations([text], np.array([1], np.uint64), 3, pieces)[0]
    assert got and all(W.decode_ids(ids.tolist(), pieces) == text for ids, _, _ in got)
    assert len({tuple(ids.tolist()) for ids, _, _ in got}) == len(got)


@pytest.mark.parametrize("text", ["the on", "a\n b", "in", "ring x"])
def test_samples_follow_the_distribution(pieces, id_of, text):
    p = distribution(text, pieces, id_of)
    n, k = 20_000, 3
    got = W.sample_segmentations([text] * n, np.arange(n).astype(np.uint64), k, pieces)
    first, second, total = {}, {}, []
    for rows in got:
        assert len(rows) == min(k, len(p))
        for ids, lp, held in rows:
            assert abs(lp - math.log(p[tuple(ids.tolist())])) < 1e-9 and held <= 0
        first[tuple(rows[0][0].tolist())] = first.get(tuple(rows[0][0].tolist()), 0) + 1
        if len(rows) > 1:
            second[tuple(rows[1][0].tolist())] = second.get(tuple(rows[1][0].tolist()), 0) + 1
        total.append(sum(math.exp(lp - held) for _, lp, held in rows))
    for s, q in p.items():
        assert abs(first.get(s, 0) - n * q) < 5 * math.sqrt(n * q) + 5
    if len(p) > 1:  # drawn without replacement
        for s, q in p.items():
            want = sum(r * q / (1 - r) for t, r in p.items() if t != s)
            assert abs(second.get(s, 0) - n * want) < 5 * math.sqrt(n * want) + 5
    # weighted by the inverse of their inclusion, samples estimate the whole (Horvitz-Thompson)
    assert abs(np.mean(total) - 1) < 5 * np.std(total) / math.sqrt(n) + 1e-6


def test_all_segmentations_when_there_are_few(pieces, id_of):
    p = distribution("in", pieces, id_of)
    got = W.sample_segmentations(["in"], np.array([3], np.uint64), 50, pieces)[0]
    assert {tuple(i.tolist()) for i, _, _ in got} == set(p) and all(h == 0 for *_, h in got)


def test_a_row_key_seeds_its_samples_whatever_stands_beside_it(pieces):
    a, b = prose(1, 30), prose(2, 40)
    alone = W.sample_segmentations([a], np.array([7], np.uint64), 3, pieces)[0]
    beside = W.sample_segmentations([b, a], np.array([1, 7], np.uint64), 3, pieces)[1]
    other = W.sample_segmentations([a], np.array([8], np.uint64), 3, pieces)[0]
    key = lambda rows: [tuple(i.tolist()) for i, _, _ in rows]
    assert key(alone) == key(beside) != key(other)


def test_long_runs_without_spaces(pieces):
    text = "abcdefghij" * 600 + " " * 300 + "é中" * 200
    got = W.sample_segmentations([text], np.array([1], np.uint64), 2, pieces)[0]
    assert len(got) == 2 and all(W.decode_ids(i.tolist(), pieces) == text and math.isfinite(lp) for i, lp, _ in got)


def test_query_round_trips(spark, documents):
    got = W.op7_gumbel_segmentations(spark, SMALL)
    back = got.withColumn("back", W.decode(spark, F.col("ids"))).join(documents.select("doc_id", "text"), "doc_id")
    assert back.where("not back <=> text or n_pieces <> size(ids) or log_inclusion > 0").count() == 0
    assert got.count() == got.select("doc_id", "ids").distinct().count() == 2 * documents.count()


def test_edges(spark, edge, empty):
    rows = W.encode_samples(edge, k=3).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert [(r["sample"], r["ids"], r["log_prob"], r["log_inclusion"]) for r in by[1]] == [(0, None, None, None)]
    assert [(r["sample"], r["ids"], r["log_prob"], r["log_inclusion"]) for r in by[2]] == [(0, [], 0.0, 0.0)]
    assert sorted(r["sample"] for r in by[4]) == [0, 0, 1, 1, 2, 2]
    assert len({tuple(r["ids"]) for r in by[4]}) == 3  # repeated rows get the same samples
    assert len(by[None]) == 4 and len(by[5]) == 3
    assert W.encode_samples(empty).count() == 0
    assert W.encode_samples(framed(spark, [(1, "x y", None, None)]), k=1).count() == 1
