import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayledger.llm import decontaminate as D
from tests_llm_data import SMALL, prose, words


def brute(text, items, window=13):
    w, hit, found = words(text), set(), set()
    for item_id, t in items:
        x = words(t)
        n = min(window, len(x))
        for i in range(len(x) - n + 1 if n else 0):
            for k in range(len(w) - n + 1):
                if w[k : k + n] == x[i : i + n]:
                    hit |= set(range(k, k + n))
                    found.add(item_id)
    return hit, found


small_text = st.lists(st.sampled_from("a b c".split()), max_size=14).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(items=st.lists(small_text, min_size=1, max_size=4), text=small_text, window=st.integers(1, 5))
def test_automaton_against_brute_force(items, text, window):
    pairs = [(str(i), t) for i, t in enumerate(items)]
    spans, found = D.Automaton([(i, D.words_of(t)) for i, t in pairs], window).scan(D.words_of(text))
    hit, want = brute(text, pairs, window)
    assert {p for a, b in spans for p in range(a, b)} == hit and found == want


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = D.op2_suffix_automaton(spark, SMALL)
    names = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({D.OP2_SQL})").fetchall()
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_blocks_give_the_same_result(spark, block_bytes):
    items = [(i, prose(i, 20 + i)) for i in range(12)] + [(99, "one two"), (100, None), (None, "solo words here"), (101, "!!")]
    items.append((3, prose(3, 23)))  # repeated
    texts = [f"{prose(50, 30)} {prose(i, 20 + i)} {prose(51, 30)} one two solo words here" for i in range(12)]
    texts += [None, "", "nothing of it", "one", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    rows = D.mark_contamination(docs, bench, block_bytes=block_bytes).collect()
    for r in rows:
        hit, found = brute(r["text"], items)
        assert {p for s in r["hits"] for p in range(s["first"], s["end"])} == hit, r["doc_id"]
        assert r["items"] == sorted(str(x) for x in found if x is not None)
        assert (r["n_words"], r["n_hit"]) == (len(words(r["text"])), len(hit))
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= r["n_words"])


def test_removal(spark):
    item = prose(7, 20)
    long = prose(8, 600)
    docs = spark.createDataFrame(
        [(1, f"Start {item}. End", 5), (2, f"{long}! {item.upper()}, {long}", 6), (3, long, 7), (4, None, None)],
        "doc_id int, text string, n_chars long",
    )
    bench = spark.createDataFrame([(1, item)], "item_id int, text string")
    out = {r["doc_id"]: r for r in D.remove_contaminated(docs, bench).collect()}
    assert set(out) == {2, 3, 4}
    assert out[2]["text"] == f"{long}! , {long}" and out[2]["n_chars"] == len(out[2]["text"])
    assert out[3]["text"] == long and out[3]["n_chars"] == 7 and out[4]["text"] is None


def test_edges(spark, edge, empty):
    bench = spark.createDataFrame([(1, prose(1, 80))], "item_id int, text string")
    out = D.mark_contamination(edge, bench)
    assert out.count() == edge.count() and set(edge.columns) <= set(out.columns)
    assert sorted(r[0] for r in out.where("contaminated").select("doc_id").collect()) == [-9, 4, 4, 8]
    assert D.mark_contamination(empty, bench).count() == 0
    none = bench.limit(0)
    assert D.mark_contamination(edge, none).where("n_hit > 0").count() == 0
    kept = D.remove_contaminated(edge, bench)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 4
    assert kept.select("hits").distinct().first()[0] == "mine"
    assert out.where(F.col("doc_id") == 5).first()["n_words"] == 800 * 25


def test_a_full_block_fits_a_worker(spark):
    """An automaton over a block of the default size, of made-up words: its states and memory."""
    import pickle
    import tracemalloc

    from stayledger.llm import decontaminate as D

    items, size, i = [], 0, 0
    while size < D.BLOCK_BYTES:
        text = prose(600_000 + i, 60)
        items.append((str(i), text))
        size, i = size + len(text), i + 1
    tracemalloc.start()
    found = D.Automaton([(k, D.words_of(t)) for k, t in items[:-1]], 13)
    used = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    print(len(found.step), "states,", used >> 20, "MB,", len(pickle.dumps(found)) >> 20, "MB pickled")
    assert used < 300 << 20
    hits, ids = found.scan(D.words_of(f"x {items[7][1]} y"))
    assert hits == [(1, 61)] and ids == {"7"}


def test_blocks_hold_whole_items_up_to_the_size(spark):
    from stayledger.llm import decontaminate as D

    rows = [(i, prose(i, 40)) for i in range(200)] + [(200, prose(7, 3000)), (201, None), (5, prose(5, 40)), (None, prose(9000, 40))]
    df = spark.createDataFrame(rows, "item_id long, text string").repartition(4)
    for limit in (1 << 30, 3000, 1):
        blocks = list(D._blocks(df, "item_id", "text", 13, limit))
        held = [x for b in blocks for by in b.windows.values() for ids in by.values() for x in ids]
        assert set(held) == {str(i) for i in range(201)} | {None}
        if limit == 3000:
            assert len(blocks) > 20
    assert len(list(D._blocks(df.limit(0), "item_id", "text", 13, 10))) == 1
