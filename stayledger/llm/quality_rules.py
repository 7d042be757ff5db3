"""Quality rules as a ledger of failure bits.

Every rule is evaluated once: `rule_ledger` reads each text once, and stores its
measurements (whole counts) and one bit for each rule that fails. Rules compare
counts with counts (``per * measure > most * of``), so that bits are exact and the
same everywhere.

A policy is a named version: the rules that count, other limits for some of them, and
how many may fail. `apply_policy` needs the ledger alone: bits where the limits are
the stored ones, the stored measurements where a policy has limits of its own. Old
ledgers serve new policies and the other way round; texts are not read again.

`ablation` says for every rule of some policies what it removes, removes alone, and
would let in if it went. The documents of each bit pattern are counted first (at most
2^rules patterns a group, combined before the shuffle), and the rules are read off
the patterns: ``bit_and`` over the patterns that hold a rule gives the rules that
always fail with it, ``bit_or`` those that ever do.

Words are runs of anything but ASCII white space; a letter is A-Z, a-z or any
character beyond ASCII (capitals: A-Z). Repeated words are those in a window of
three words that stands twice or more in the text, the first time included.

Defined results: null and empty texts have no words and fail ``few_words`` only;
shares of nothing do not fail. Repeated rows each have their own ledger row; an empty
table gives an empty one. Columns of the input are kept, those named like an output
replaced. A very long text is measured whole, in time n log n of its words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.llm.frames import table
from stayledger.llm.textbytes import texts

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_bullet_lines",
    "n_ellipsis_lines",
    "n_letter_words",
    "n_letters",
    "n_capitals",
    "top_word",
)
SYMBOLS = b"#*$%&|<>"
BULLETS = tuple(x.encode() for x in ("-", "*", "•", "‣", "●"))
ELLIPSES = (b"...", "…".encode())
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))
_NO_LETTER = bytes(b for b in range(128) if b not in _LETTERS)
_TAILS = bytes(range(0x80, 0xC0))  # the bytes of a character after its first


@dataclass(frozen=True)
class Rule:
    """Fails when ``per * measure`` is over ``most`` or under ``least`` times ``of``
    (a measure, or one)."""

    name: str
    measure: str
    of: str | None = None
    most: int | None = None
    least: int | None = None
    per: int = 1


#: A rule's place is its bit: add new ones at the end, never move one.
RULES = (
    Rule("few_words", "n_words", least=50),
    Rule("repeated_windows", "n_repeat_words", "n_words", most=50, per=100),
    Rule("many_words", "n_words", most=100_000),
    Rule("short_words", "word_chars", "n_words", least=3),
    Rule("long_words", "word_chars", "n_words", most=10),
    Rule("symbols", "n_symbols", "n_words", most=10, per=100),
    Rule("bullets", "n_bullet_lines", "n_lines", most=90, per=100),
    Rule("ellipses", "n_ellipsis_lines", "n_lines", most=30, per=100),
    Rule("letterless_words", "n_letter_words", "n_words", least=80, per=100),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=50, per=100),
    Rule("capitals", "n_capitals", "n_letters", most=50, per=100),
    Rule("top_word", "top_word", "n_words", most=30, per=100),
)
BIT = {rule.name: i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """``limits`` replaces (most, least) of a rule, in its own ``per``; ``allowed``
    failures are forgiven, but none of ``firm`` rules."""

    name: str
    version: int
    rules: tuple[str, ...]
    limits: dict[str, tuple[int | None, int | None]] = field(default_factory=dict)
    allowed: int = 0
    firm: tuple[str, ...] = ()

    def mask(self) -> int:
        return sum(1 << BIT[r] for r in self.rules)


BASE = ("few_words", "repeated_windows")
#: Lengths of words differ between languages, so that ``general`` leaves them out; one
#: repeated line of three is no junk, so that duplicate lines count from over half.
POLICIES = {
    ("base", 1): Policy("base", 1, BASE),
    ("general", 1): Policy(
        "general", 1, (*BASE, "symbols", "bullets", "ellipses", "letterless_words", "duplicate_lines", "capitals", "top_word")
    ),
    ("strict", 1): Policy("strict", 1, tuple(BIT), {"duplicate_lines": (30, None), "symbols": (5, None)}),
    ("lenient", 1): Policy("lenient", 1, tuple(BIT), {"few_words": (None, 20)}, allowed=1, firm=("few_words",)),
}
DEFAULT = POLICIES["general", 1]


def measure(raw: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = (raw or b"").split()  # bytes.split: on \x20 and \x09-\x0D
    if not words:
        return (0,) * len(MEASURES)
    joined = b"".join(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    times = np.bincount(ids)
    lines = [x.strip() and x for x in raw.split(b"\n")]
    lines = [x for x in lines if x]
    return (
        len(words),
        _without(joined, _TAILS),
        len(joined) - _without(joined, SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(ids, len(number)),
        len(lines),
        sum(x.lstrip().startswith(BULLETS) for x in lines),
        sum(x.rstrip().endswith(ELLIPSES) for x in lines),
        int(sum(n for w, n in zip(number, times.tolist()) if w.translate(None, _NO_LETTER))),
        _without(joined, _NO_LETTER + _TAILS),
        len(joined) - _without(joined, _CAPITALS),
        int(times.max()),
    )


def _without(raw: bytes, gone: bytes) -> int:
    return len(raw.translate(None, gone))


def _repeated(ids: np.ndarray, n_ids: int) -> int:
    """Words in windows of three that stand twice or more."""
    if len(ids) < 4:
        return 0
    _, two = np.unique(ids[:-1] * n_ids + ids[1:], return_inverse=True)  # numbers of the pairs
    _, place, times = np.unique(two[:-1] * n_ids + ids[2:], return_inverse=True, return_counts=True)
    again = times[place] > 1
    hit = np.zeros(len(ids), bool)
    for i in range(3):
        hit[i : i + len(again)] |= again
    return int(hit.sum())


_MEASURED = "struct<" + ",".join(f"{m}:long" for m in MEASURES) + ">"


def _measured(text: Column) -> Column:
    @F.arrow_udf(_MEASURED)
    def measured(column: pa.Array) -> pa.Array:
        rows = [measure(t) for t in texts(column)]
        columns = zip(*rows) if rows else [[]] * len(MEASURES)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], names=list(MEASURES))

    return measured(text)


def _fails(rule: Rule, value, limits: tuple[int | None, int | None]) -> Column:
    """``value(name)`` is the column of a measure."""
    most, least = limits
    share, whole = value(rule.measure) * rule.per, value(rule.of) if rule.of else F.lit(1)
    over = share > whole * most if most is not None else F.lit(False)
    under = share < whole * least if least is not None else F.lit(False)
    return over | under


def _bits(value, limits: dict | None = None, names: Sequence[str] = tuple(BIT)) -> Column:
    out = F.lit(0).cast("long")
    for rule in RULES:
        if rule.name in names:
            bound = (limits or {}).get(rule.name, (rule.most, rule.least))
            out = out + F.when(_fails(rule, value, bound), F.lit(1 << BIT[rule.name])).otherwise(0)
    return out


def rule_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``measures`` (a struct of counts) and ``failed_bits`` (rule i: bit i)."""
    found = docs.withColumn("measures", _measured(F.col(text)))
    return found.withColumn("failed_bits", _bits(lambda m: F.col("measures")[m]))


def policy_bits(policy: Policy) -> Column:
    """The ledger's bits as ``policy`` has them: only its rules, by its limits."""
    own = tuple(r for r in policy.rules if r in policy.limits)
    stored = F.col("failed_bits").bitwiseAND(F.lit(policy.mask() & ~sum(1 << BIT[r] for r in own)))
    return stored + _bits(lambda m: F.col("measures")[m], policy.limits, own) if own else stored


def _kept(bits: Column, policy: Policy) -> Column:
    firm = bits.bitwiseAND(F.lit(sum(1 << BIT[r] for r in policy.firm))) == 0
    return firm & (F.bit_count(bits) <= policy.allowed)


def _names(bits: Column) -> Column:
    """The names of the bits, in their order, comma-joined."""
    names = [F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(rule.name)) for i, rule in enumerate(RULES)]
    return F.concat_ws(",", *names)


def apply_policy(ledger: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Adds ``policy`` (name-version), ``kept`` and ``reasons`` (the policy's rules that
    fail)."""
    bits = policy_bits(policy)
    return (
        ledger.withColumn("policy", F.lit(f"{policy.name}-{policy.version}"))
        .withColumn("kept", _kept(bits, policy))
        .withColumn("reasons", _names(bits))
    )


def ablation(ledger: DataFrame, policies: Sequence[Policy], by: Sequence[str] = ()) -> DataFrame:
    """For each group of ``by``, policy and rule of it: ``n_docs``, ``n_kept``,
    ``n_failed`` (the rule fails), ``n_alone`` (no other rule of the policy does),
    ``n_kept_without`` (kept if the rule went), ``always_with`` and ``ever_with``
    (rules that fail with it in all, in any, of its documents)."""
    parts = []
    for policy in policies:
        patterns = ledger.select(*by, policy_bits(policy).alias("_bits")).groupBy(*by, "_bits").agg(F.count(F.lit(1)).alias("_n"))
        rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).alias("bit")) for r in policy.rules))
        one = patterns.select("*", F.explode(rules).alias("_of")).select("*", F.col("_of.rule").alias("rule"), F.col("_of.bit").alias("_bit"))
        bits, bit, n = F.col("_bits"), F.col("_bit"), F.col("_n")
        others = bits.bitwiseAND(F.bitwise_not(bit))
        fails = bits.bitwiseAND(bit) != 0
        total = lambda where: F.sum(F.when(where, n).otherwise(0))
        found = one.groupBy(*by, "rule").agg(
            F.sum("_n").alias("n_docs"),
            total(_kept(bits, policy)).alias("n_kept"),
            total(fails).alias("n_failed"),
            total(bits == bit).alias("n_alone"),
            total(_kept(others, policy)).alias("n_kept_without"),
            _names(F.coalesce(F.bit_and(F.when(fails, others)), F.lit(0))).alias("always_with"),
            _names(F.coalesce(F.bit_or(F.when(fails, others)), F.lit(0))).alias("ever_with"),
        )
        parts.append(found.select(*by, F.lit(f"{policy.name}-{policy.version}").alias("policy"), *found.columns[len(by) :]))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def op11_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = rule_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = apply_policy(ledger)
    base = sum(1 << BIT[r] for r in BASE)
    return found.select(
        "doc_id",
        *(F.col("measures")[m].alias(m) for m in MEASURES[:5]),
        (F.col("failed_bits").bitwiseAND(F.lit(base)) != 0).alias("base_failed"),
        "kept",
        *(F.col("measures")[m].alias(m) for m in MEASURES[5:]),
        "failed_bits",
        "policy",
        "reasons",
    )


def _sql_bits() -> str:
    out = []
    for i, r in enumerate(RULES):
        whole = r.of or "1"
        test = f"{r.per} * {r.measure} > {r.most} * {whole}" if r.most is not None else f"{r.per} * {r.measure} < {r.least} * {whole}"
        out.append(f"CASE WHEN {test} THEN {1 << i} ELSE 0 END")
    return " + ".join(out)


def _sql_reasons() -> str:
    cases = [f"CASE WHEN failed_bits & {1 << BIT[r]} <> 0 THEN '{r}' END" for r in sorted(DEFAULT.rules, key=BIT.__getitem__)]
    return f"concat_ws(',', {', '.join(cases)})"


_WORD_SQL = "'[^\\x20\\x09-\\x0D]+'"
OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), {_WORD_SQL}) AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
),
windows AS (
  SELECT r, k, w[k] AS a, w[k + 1] AS b, w[k + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM d WHERE len(w) > 2)
),
again AS (SELECT r, unnest(list(k)) AS k FROM windows GROUP BY r, a, b, c HAVING count(*) > 1),
repeated AS (SELECT r, count(DISTINCT k + i) AS n FROM again, (SELECT unnest([0, 1, 2]) AS i) GROUP BY r),
top AS (
  SELECT r, max(n) AS n FROM (SELECT r, x, count(*) AS n FROM (SELECT r, unnest(w) AS x FROM d) GROUP BY r, x) GROUP BY r
),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•‣●]'))) AS n_bullet_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS n_ellipsis_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_letter_words,
    length(regexp_replace(t, '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, coalesce(top.n, 0) AS top_word
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN top USING (r)
),
bits AS (SELECT *, {_sql_bits()} AS failed_bits FROM m)
SELECT doc_id, {', '.join(f'CAST({x} AS BIGINT) AS {x}' for x in MEASURES)}, CAST(failed_bits AS BIGINT) AS failed_bits,
  failed_bits & {sum(1 << BIT[r] for r in BASE)} <> 0 AS base_failed, failed_bits & {DEFAULT.mask()} = 0 AS kept,
  '{DEFAULT.name}-{DEFAULT.version}' AS policy, {_sql_reasons()} AS reasons
FROM bits
"""
