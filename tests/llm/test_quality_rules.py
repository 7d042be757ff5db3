"""The rule ledger against measurements, policies and ablations made in plain Python."""

import re
from collections import Counter
from dataclasses import replace

import pytest

from stayledger.llm import quality_rules as Q
from tests_llm_data import SMALL, prose

WORDS = re.compile("[^\x20\x09-\x0d]+")


def slow_measure(text):
    text = text or ""
    w = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {k + i for k, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for i in range(3)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    letter = re.compile("[A-Za-z]|[^\x00-\x7f]")
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup,
        "n_repeat_words": len(hit),
        "n_lines": len(lines),
        "n_bullet_lines": sum(WORDS.search(x)[0][0] in "-*•‣●" for x in lines),
        "n_ellipsis_lines": sum(WORDS.findall(x)[-1].endswith(("...", "…")) for x in lines),
        "n_letter_words": sum(bool(letter.search(x)) for x in w),
        "n_letters": len(letter.findall(text)),
        "n_capitals": len(re.findall("[A-Z]", text)),
        "top_word": max(Counter(w).values(), default=0),
    }


def slow_failed(m, limits=None):
    out = set()
    for r in Q.RULES:
        most, least = (limits or {}).get(r.name, (r.most, r.least))
        share, whole = r.per * m[r.measure], m[r.of] if r.of else 1
        if (most is not None and share > most * whole) or (least is not None and share < least * whole):
            out.add(r.name)
    return out


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "a b c a b c",
    "a a a a",
    "a b c d a b",
    "x\ny\nx\n x\n\n\nx",
    "- one\n* two\n • three\nplain - four",
    "so it goes...\nand on…  \nend.",
    "### $$$ <b> | | | 100% &amp; " * 9,
    "SHOUT LOUD " * 30,
    prose(3, 120),
    prose(3, 120) + "\n" + prose(3, 120),
    "é ü  中文 \u0085x",
    "1 2 3 " * 40,
    "\n".join(prose(i, 6) for i in range(12)),
]


@pytest.fixture(scope="module")
def ledger(spark):
    rows = [(i, t, "x" if i % 3 else "y") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string")
    return Q.rule_ledger(df.repartition(3)).cache()


def test_measurements_and_bits(ledger):
    rows = ledger.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        m = slow_measure(r["text"])
        assert r["measures"].asDict() == m, r["text"]
        assert {n for n, b in Q.BIT.items() if r["failed_bits"] >> b & 1} == slow_failed(m)


def test_a_long_text_is_measured_whole(spark):
    text = prose(1, 150_000) + " end of it end of it"
    assert Q.measure(text.encode()) == tuple(slow_measure(text).values())


@pytest.mark.parametrize("policy", Q.POLICIES.values(), ids=str)
def test_policies_from_the_ledger_alone(ledger, policy):
    rows = Q.apply_policy(ledger.drop("text"), policy).collect()
    for r in rows:
        m = slow_measure(TEXTS[r["doc_id"]])
        failed = slow_failed(m, policy.limits) & set(policy.rules)
        assert r["reasons"] == ",".join(n for n in Q.BIT if n in failed)
        assert r["kept"] == (len(failed) <= policy.allowed and not failed & set(policy.firm))
        assert r["policy"] == f"{policy.name}-{policy.version}"
    assert len(rows) == len(TEXTS)


def test_ablation(ledger):
    policies = [*Q.POLICIES.values(), replace(Q.DEFAULT, version=9, limits={"few_words": (None, 7)})]
    got = {(r["part"], r["policy"], r["rule"]): r for r in Q.ablation(ledger, policies, ["part"]).collect()}
    assert len(got) == 2 * sum(len(p.rules) for p in policies)
    for p in policies:
        kept = lambda f, p=p: len(f) <= p.allowed and not f & set(p.firm)
        for part in "xy":
            docs = [slow_measure(t) for i, t in enumerate(TEXTS) if ("x" if i % 3 else "y") == part]
            docs = [slow_failed(m, p.limits) & set(p.rules) for m in docs]
            for rule in p.rules:
                r, with_it = got[part, f"{p.name}-{p.version}", rule], [f - {rule} for f in docs if rule in f]
                assert r["n_docs"] == len(docs) and r["n_failed"] == len(with_it)
                assert r["n_kept"] == sum(map(kept, docs)) and r["n_alone"] == with_it.count(set())
                assert r["n_kept_without"] == sum(kept(f - {rule}) for f in docs)
                always = set.intersection(*with_it) if with_it else set()
                assert r["always_with"] == ",".join(n for n in Q.BIT if n in always)
                assert r["ever_with"] == ",".join(n for n in Q.BIT if n in set().union(*with_it))
    whole = {(r["policy"], r["rule"]): r["n_docs"] for r in Q.ablation(ledger, policies).collect()}
    assert set(whole.values()) == {len(TEXTS)}


def test_query(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = Q.op11_rule_ledger(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        m = slow_measure(texts[r["doc_id"]])
        assert {k: r[k] for k in m} == m
        assert r["base_failed"] == (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"])
        assert r["kept"] == (not slow_failed(m) & set(Q.DEFAULT.rules)) and not (r["kept"] and r["base_failed"])


def test_good_prose_is_kept_and_junk_is_not(spark):
    good = [prose(i, 60 + 7 * i) for i in range(100)] + ["\n".join(prose(40 * i + j, 9) for j in range(20)) for i in range(50)]
    bad = ["CLICK HERE NOW!! " * 40, "a | b | c | " * 40, "\n".join(["same line of text"] * 40), "1 23 456 7,8 " * 30, "too short"]
    df = spark.createDataFrame([(t, t in good) for t in good + bad], "text string, good boolean")
    assert Q.apply_policy(Q.rule_ledger(df)).where("kept <> good").count() == 0


def test_edges(edge, empty):
    out = Q.apply_policy(Q.rule_ledger(edge))
    assert out.count() == edge.count() and set(edge.columns) <= set(out.columns)
    assert {r["reasons"] for r in out.where("text is null or text = ''").collect()} == {"few_words"}
    assert Q.apply_policy(Q.rule_ledger(empty)).count() == 0
    assert Q.ablation(Q.rule_ledger(empty), [Q.DEFAULT]).count() == 0
