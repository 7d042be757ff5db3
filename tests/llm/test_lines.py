import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stayledger.llm import lines as L
from tests_llm_data import SMALL, Union, fold, framed, prose


def folded(line):
    return re.sub("[\x09-\x0d\x20]+", " ", fold(line)).strip(" ")


def brute(docs, shingle=8, similarity=0.8, min_chars=8):
    """{doc_id: removed line numbers}; doc ids are different and not null."""
    places = defaultdict(list)
    for i, t in docs:
        for k, x in enumerate((t or "").split("\n")):
            if len(folded(x)) >= min_chars:
                places[folded(x)].append((i, k))
    every = sorted(places)
    sets = [{x[i : i + shingle] for i in range(len(x) - shingle + 1)} for x in every]
    by_shingle, u = defaultdict(set), Union()
    for i, s in enumerate(sets):
        u.root(i)
        for j in set().union(*[by_shingle[g] for g in s]):
            both = len(s & sets[j])
            if both >= similarity * (len(s) + len(sets[j]) - both):
                u.join(i, j)
        for g in s:
            by_shingle[g].add(i)
    groups = defaultdict(list)
    for i, x in enumerate(every):
        groups[u.root(i)] += places[x]
    out = defaultdict(list)
    for g in groups.values():
        for i, k in sorted(g)[1:]:
            out[i].append(k)
    return {i: sorted(v) for i, v in out.items()}


def test_query_against_brute_force(spark, documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = brute(docs)
    rows = L.op8_minhash_lines(spark, SMALL).collect()
    assert {r["doc_id"]: r["removed"] for r in rows} == {i: want.get(i, []) for i, _ in docs}
    for r in rows:
        text = dict(docs)[r["doc_id"]] or ""
        assert (r["n_lines"], r["n_removed"]) == (text.count("\n") + 1, len(r["removed"]))


def variants(n):
    """``n`` lines, each the base with one or two words of its own."""
    base = prose(77, 60).split()
    out = []
    for i in range(n):
        w = list(base)
        w[i * 7 % 60] = f"own{i}x"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("limit", [4096, 16])
def test_fuzzy_groups_and_buckets_over_the_limit(spark, limit):
    docs = [(i, f"{prose(1000 + i, 12)}\n{x}") for i, x in enumerate(variants(60))]
    docs += [(200, "The same LINE, again and   again!\n\n}"), (201, "the same line, again and again!\n}\n"), (202, None), (203, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc"]: r["removed"] for r in L.repeated_lines(df, run_limit=limit).collect()}
    keys = {r["doc"]: r["doc_id"] for r in df.select("doc_id", L.doc_key(F.col("doc_id"), F.col("text")).alias("doc")).collect()}
    want = brute(docs)
    assert len(want) >= 59 and {keys[d]: v for d, v in got.items()} == want


def templated(n, own):
    """Lines of one template, each with ``own`` random characters, in pairs that differ
    in the last of them."""
    import random
    rng, base, out = random.Random(own), prose(9, 12), []
    for _ in range(n // 2):
        w = "".join(rng.choice("bcdfghjklmnp") for _ in range(own))
        out += [f"{base} {w} {prose(10, 3)}", f"{base} {w[:-1]}z {prose(10, 3)}"]
    return out


@pytest.mark.parametrize("own", [4, 6, 9, 12, 16, 24])
def test_long_buckets_of_templated_lines_against_brute_force(spark, own):
    """Whatever share of the lines is their own: all alike, none but the pairs, between."""
    lines = templated(120, own)
    docs = list(enumerate(lines))
    want = brute(docs)
    o = {"shingle": 8, "similarity": 0.8, "run_limit": 8}
    # one bucket holds all of them
    line = spark.createDataFrame([(i, x) for i, x in docs], "key long, line string")
    met = line.selectExpr("7L as bucket", "key").repartition(4)
    u = Union()
    for links in L._long_links(met, line, o):
        for a, b in links.collect():
            u.join(a, b)
    assert sorted(i for i in range(len(lines)) if u.root(i) != i) == sorted(want)


def test_a_long_bucket_takes_rows_in_proportion(spark, monkeypatch):
    """50,000 lines of one template that are not alike, beside pairs that are: as many
    rows are solved for twice the lines, twice over."""
    seen, solve = [], L._solve

    def counted(rows, o):
        seen[-1] += rows.count()
        return solve(rows, o)
    monkeypatch.setattr(L, "_solve", counted)
    for n in (25_000, 50_000):
        seen.append(0)
        line = spark.range(n).selectExpr(
            "id as key", "concat('alpha beta gamma delta epsilon zeta ', substring(md5(cast(id div 2 as string)), 1, 15), "
            "case when id % 2 = 0 then 'x' else 'y' end) as line")
        o = {"shingle": 8, "similarity": 0.8, "run_limit": 512}
        u = Union()
        for links in L._long_links(line.selectExpr("1L as bucket", "key"), line, o):
            for a, b in links.collect():
                u.join(a, b)
        assert all(u.root(i) == i - i % 2 for i in range(n))
    assert seen[1] < 2.1 * seen[0] and seen[1] < 40 * 50_000


def test_signatures_meet_at_the_similarity():
    """Recall over random pairs near the threshold, and few meetings far below it."""
    pairs, met, far = 0, 0, 0
    for i in range(300):
        w = prose(i, 50).split()
        x = " ".join(w)
        for j in (5, 25, 40):
            w[j] = f"z{i}q"
        y = " ".join(w)
        a, b = L.shingle_set(x, 8), L.shingle_set(y, 8)
        s = L._common(a, b) / (len(a) + len(b) - L._common(a, b))
        g = L.buckets([x.encode(), y.encode(), prose(5000 + i, 50).encode()], 8, 12, 5)
        if s >= 0.8:
            pairs += 1
            met += bool((g[0] == g[1]).any())
        far += bool((g[0] == g[2]).any())
    assert pairs > 50 and met >= 0.97 * pairs and far <= 3


def test_exact_similarity_of_packed_and_other_shingles():
    for a, b in [("abcdefgh", "abcdefgh"), ("é" * 30 + "abc", "é" * 29 + "abc"), ("中文" * 20, "中文" * 20 + "x"), ("ab", "ab"), ("", "x")]:
        x = {a[i : i + 8] for i in range(max(1, len(a) - 7))}
        y = {b[i : i + 8] for i in range(max(1, len(b) - 7))}
        want = len(x & y) >= 0.8 * len(x | y)
        assert bool(L.like_links([a, b], 8, 0.8)) == want, (a, b)


def test_dedup_rewrites_texts(spark):
    a, b = prose(1, 20), prose(2, 20)
    docs = framed(spark, [(1, f"{a}\n{b}", "en", "s"), (2, f"{b.upper()}\nshort\n{a}", "en", "s"), (3, a, "en", "s"), (4, "x\n\ny", None, None)])
    out = L.dedup_lines(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["removed"]) for r in out.collect()}
    assert got == {1: (f"{a}\n{b}", len(a) + len(b) + 1, "mine"), 2: ("short", 5, "mine"), 4: ("x\n\ny", 4, "mine")}


def test_short_lines_are_judged(spark):
    docs = [(1, "ok, fine\nno"), (2, "OK,  fine\n}"), (3, "ok, fin"), (4, "a b c d e f g\na b c d e f g h i"), (5, "a b c d e f g")]
    got = L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: "ok, fine\nno", 2: "}", 3: "ok, fin", 4: "a b c d e f g\na b c d e f g h i"}
    n = {sf: sum(map(len, brute([(r[0], r[1]) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select(
        "doc_id", "text").collect()]).values())) for sf in ("sf0.001",)}
    assert n == {"sf0.001": 294}


def test_edges(edge, empty):
    out = L.dedup_lines(edge)
    assert out.columns == edge.columns
    rows = out.collect()
    # 4 (twice) and 8 are one line, near to -9's, which is first
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == [
        (False, x) for x in (-9, 1, 2, 3, 5, 6, 7)] + [(True, 0), (True, 0)]
    assert L.dedup_lines(empty).count() == 0 and L.repeated_lines(empty).count() == 0


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_a_large_group_is_compared_line_against_all(monkeypatch, similarity):
    """Not pair by pair, with the links that comparing pairs gives."""
    lines = sorted(variants(40) + templated(60, 4) + templated(60, 24) + [f"é{x}" for x in templated(20, 9)])
    monkeypatch.setattr(L, "_FEW", len(lines))
    want = L.like_links(lines, 8, similarity)
    monkeypatch.undo()
    calls = []
    monkeypatch.setattr(L, "_common", lambda a, b: calls.append(1))
    assert L.like_links(lines, 8, similarity) == want and (want or similarity == 1.0) and not calls


def test_folded_lines_with_and_without_runs_of_spaces():
    for text in ("", " ", "A b\nC", " a b \n\n c ", "a\t b\x0b\n\r\x0cc  D \n", "é\u00a0 x\n y\r\nz"):
        assert [x.decode() for x in L.fold_lines(text.encode())] == [folded(x) for x in text.split("\n")]
    assert L.fold_lines(None) == [b""]
