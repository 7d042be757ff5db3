"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from stayledger.llm import prefix_trie as T
from tests_llm_data import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, depth string, shard_conv string"
COLUMNS = ["conv", "depth", "parent", "n", "n_children", "n_leaves", "saved", "ends_sha256"]


def sequences(rows):
    """Turns of one number are alike here, or told apart by role."""
    out = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            out[c].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [x[1:] for x in sorted(v)] for c, v in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = convs.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        out[c] = first[:h] + own[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return Counter(
        (
            min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
            hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest(),
        )
        for k, m in members.items()
    )


def framed(spark, rows):
    return spark.createDataFrame([(*r, "mine", "mine") for r in rows], SCHEMA).repartition(5)


def trie(df, build=T.rebuilt_turns, band=T.BAND, **options):
    turns = build(T.number_turns(df), band=band)
    return Counter(map(tuple, T.prefix_trie(turns, band=band, **options).select(*COLUMNS).collect()))


def forest(seed, n, longest):
    """Conversations that share prefixes, with copies."""
    rng, rows, kept = random.Random(seed), [], [[]]
    for c in rng.sample(range(-300, 3000), n):
        start = rng.choice(kept)
        turns = start[: rng.randint(0, len(start))]
        turns = turns + [("ua"[len(turns) + i & 1], rng.choice("xyz") * rng.randint(0, 3)) for i in range(rng.randint(0, longest))]
        kept.append(turns)
        rows += [(c, i - 3, r, t) for i, (r, t) in enumerate(turns or [("u", "x")])]
    rng.shuffle(rows)
    return rows


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = T.op12_time_forward_trie(spark, SMALL)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert all(t == "bigint" for c, t in got.dtypes if c != "ends_sha256")
    assert Counter(map(tuple, got.collect())) == brute(rebuilt(sequences(rows)))


@pytest.mark.parametrize("band, limit", [(2, 1), (3, 4), (4096, 1 << 18)])
def test_bands_shards_and_spilling_do_not_matter(spark, band, limit):
    rows = forest(7, 150, 9)
    df = framed(spark, rows)
    assert trie(df, band=band, queue_limit=limit) == brute(rebuilt(sequences(rows)))
    assert trie(df, T.turns_as_they_are, band=band, queue_limit=limit) == brute(sequences(rows))


def test_one_long_conversation_and_a_large_group_of_copies(spark):
    rows = [(5, i, "u", str(i)) for i in range(700)] + [(100 + 7 * c, i, "u", str(i)) for c in range(120) for i in range(4)]
    rows += [(100 + 7 * c, i, "u", str(i)) for c in range(120, 150) for i in range(4, 9)]
    got = trie(framed(spark, rows), T.turns_as_they_are, band=16, queue_limit=8)
    assert got == brute(sequences(rows))


def test_nulls_ties_repeats_and_turnless_conversations(spark):
    rows = [
        (None, 0, "u", "lost"),
        (0, None, "u", "first"),
        (0, 2, None, None),
        (0, 2, None, None),
        (1, 0, "u", "first"),
        (1, 1, "", ""),
        (7, -5, "a", "é\U0001f600"),
        (7, 3, "a", "tie"),
        (7, 3, "b", "tie"),
        (100, 1, "u", ""),
        (-3, 0, "u", "below zero"),
        (-100, 0, "u", "first of its family"),
        (-101, 0, "u", "own"),
    ]
    rows += [(c, 0, "u", "only") for c in range(9000, 9040)]  # family 9000 has one turn, h is up to 5
    rows += [(c, 0, "u", "no first") for c in range(501, 520)]  # 500 is absent
    got = trie(framed(spark, rows))
    assert got == brute(rebuilt(sequences(rows)))
    assert any(not v for v in rebuilt(sequences(rows)).values())


def test_empty(spark):
    assert not trie(framed(spark, []))
    assert not trie(framed(spark, [(None, 1, "u", "x")]))


def test_queue_spills_and_keeps_the_order():
    rng = random.Random(3)
    items = [(rng.randint(-50, 0), rng.randint(0, 9), i) for i in range(5000)]
    queue = T.SpillingQueue(37)
    got, waiting = [], 0
    for x in items:
        queue.push(x)
        waiting += 1
        if waiting > 3000:
            got.append(queue.pop())
            waiting -= 1
    assert queue.runs
    while queue.first() is not None:
        assert queue.first() == (x := queue.pop())
        got.append(x)
    assert sorted(got) == sorted(items) and got[-2999:] == sorted(got[-2999:])


def test_digest_of_many_ids_is_of_one_text(spark):
    n = 10_000
    df = spark.range(n).selectExpr("5 as rep", "3L as depth", "id * 3 - 7000 as conv").repartition(9)
    (row,) = T._end_digests(df.selectExpr("cast(rep as long) as rep", "depth", "conv")).collect()
    expected = hashlib.sha256(",".join(str(i * 3 - 7000) for i in range(n)).encode()).hexdigest()
    assert tuple(row) == (5, 3, expected)
