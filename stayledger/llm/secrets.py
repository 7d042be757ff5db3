"""Secret scan: fixed patterns, and a randomness test battery for tokens that no
pattern names (Spark expressions only).

Base spans come from three patterns (`BASE_RULES`). The battery looks at every
token: a maximal run of 20 or more of ``A-Za-z0-9+/_-`` (and up to two ``=``).

1. Its encoding is inferred from its characters: hex, base32 or base64.
2. Three tests ask whether it looks drawn evenly from that alphabet:
   chi-squared of the character counts (Wilson-Hilferty z), the number of
   changes between digits and other characters (runs), and the lag-1
   correlation of alphabet positions (serial). All must be within ``max_z``.
3. The same chi-squared statistic gets a p-value under the opposite
   hypothesis, a word or name of ordinary text: characters that repeat with the
   coincidence rate of prose, which moves the mean by n * (k * coincidence - 1).
   The longer the token, the smaller the p-value a random one reaches.
4. Benjamini-Hochberg over all tokens of all documents, apart for each encoding
   and length band, chooses the p-value up to which tokens are reported, so
   that short tokens, which are many and tell little, do not lower the bar for
   long ones. Only a histogram (encodings x bands x p bins, at most
   ``3 * 12 * 241`` rows whatever the input) leaves the executors.

The discovery control is over all tokens, so the rate holds for the tokens up to the
bar; the battery and the overlap with base spans then only take tokens away.

The scan is two projections over the table and one small aggregation: no text is
shuffled, and no Python worker runs. Work on a text grows with its length and the
logarithm of its matches (places are sums along blocks of matches, `prefixes`;
overlaps come from one sort); the matches of one text are held together.

Defined results: a null text counts as empty; empty tables stay empty; repeated
rows each get their spans; spans are in code points, end exclusive; a token that
overlaps a base span is not reported (the base span stays); columns of the input
are kept and those named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.llm.frames import let, part_of, table

#: Fixed values of the contract: kind, pattern, least length, group that length is of.
BASE_RULES = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    ("access", r"AKIA[A-Z0-9]+", 16, 0),
    ("hex", r"[0-9a-f]+", 32, 0),
]
#: Runs shorter than this fail the base rule anyway, and a failing run hides no
#: later one (it is maximal), so the scan may ask for the length at once.
_SCAN = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"(?<![0-9a-f])[0-9a-f]{32,}+"}

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
_ALPHABET = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
_DIGITS = {"hex": 10, "base32": 6, "base64": 10}
#: Chance that two characters of ordinary text in that alphabet are equal
#: (letters of European prose; a-f alone are the more uneven).
COINCIDENCE = {"hex": 0.2, "base32": 0.07, "base64": 0.065}
RANDOM = 3  # kind number behind the base kinds
KINDS = [k for k, *_ in BASE_RULES] + ["random"]


_BLOCK = 256


def prefixes(values: Column, joined, zero: Column, kind: str) -> Column:
    """For each value of an array of ``kind``, all values before it ``joined`` (an associative
    function), ``zero`` for the first. In blocks, as an array that grows is copied for
    every value: the blocks' totals first, then the values of each block from its start."""

    def cut_up(array: Column) -> Column:
        starts = F.sequence(F.lit(0), ((F.size(array) - 1) / _BLOCK).cast("int"))
        blocks = F.transform(starts, lambda i: part_of(array, i * _BLOCK, _BLOCK))
        return F.when(F.size(array) > 0, blocks).otherwise(F.array().cast(f"array<array<{kind}>>"))

    def along(block: Column, start: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(start.alias("at"), F.array().cast(f"array<{kind}>").alias("out")),
            lambda acc, v: F.struct(joined(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )

    def over(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, zero, joined))
        return F.flatten(F.zip_with(blocks, along(totals, zero), along))

    return let(let(values, cut_up), over)


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, hit>> of the pattern's matches, leftmost, not overlapping."""
    rx = F.lit(pattern)

    def steps(hits: Column) -> Column:  # what stands before each hit, and the hit; the last gap has none
        return F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)),
            hits,
            lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("size"), h.alias("hit")),
        )

    def placed(steps: Column) -> Column:
        before = prefixes(F.transform(steps, lambda x: x["gap"] + x["size"]), lambda a, b: a + b, F.lit(0), "int")
        return F.zip_with(steps, before, lambda x, at: F.struct((at + x["gap"]).alias("start"), x["hit"].alias("hit")))

    found = let(let(F.regexp_extract_all(text, rx, F.lit(0)), steps), placed)
    return F.when(F.regexp(text, rx), found).otherwise(F.array().cast("array<struct<start:int,hit:string>>"))


def _base_spans(text: Column) -> Column:
    """All base spans, as (start, kind number, end), sorted."""
    kinds = []
    for no, (kind, pattern, least, group) in enumerate(BASE_RULES):

        def long_enough(m: Column) -> Column:
            return F.length(F.regexp_extract(m["hit"], pattern, group)) >= least  # noqa: B023

        def span(m: Column) -> Column:
            end = m["start"] + F.length(m["hit"])
            return F.struct(m["start"].alias("start"), F.lit(no).alias("kind"), end.alias("end"))  # noqa: B023

        kinds.append(F.transform(F.filter(_matches(text, _SCAN.get(kind, pattern)), long_enough), span))
    return F.array_sort(F.concat(*kinds))


def _log10_normal_cdf(z: Column) -> Column:
    """log10 of the normal distribution function: a logistic fit around 0, the
    Mills ratio in the lower tail."""
    near = -F.log10(1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))
    far = -z * z / (2 * 2.302585092994046) - F.log10(-z * 2.5066282746)
    return F.when(z > -3, near).otherwise(far)


_FOUND = ["start", "end", "encoding", "band", "even", "bin"]


def _tested(hits: Column, coincidence: dict[str, float], max_z: float) -> Column:
    """The tokens' structs: place, encoding, length band, whether the battery holds, and
    the bin (tenths of log10, 0 to 240) of the p-value under ordinary text. Each step
    names what the next ones use, so that nothing is worked out twice."""

    def by(enc: Column, values: dict) -> Column:
        return F.when(enc == "hex", values["hex"]).when(enc == "base32", values["base32"]).otherwise(values["base64"])

    def step(rows: Column, new) -> Column:
        return F.transform(rows, lambda t: F.struct(t.alias("t"), *(c.alias(name) for name, c in new(t).items())))

    rows = F.transform(
        hits,
        lambda m: F.struct(m["start"].alias("start"), (m["start"] + F.length(m["hit"])).alias("end"), F.rtrim(m["hit"], F.lit("=")).alias("body")),
    )
    rows = step(rows, lambda t: {
        "n": F.length(t["body"]),
        "enc": F.when(F.regexp(t["body"], F.lit("^([0-9a-f]+|[0-9A-F]+)$")), "hex")
        .when(F.regexp(t["body"], F.lit("^[A-Z2-7]+$")), "base32").otherwise("base64"),
    })
    rows = step(rows, lambda t: {
        "plain": F.when(t["enc"] == "hex", F.lower(t["t"]["body"])).otherwise(F.translate(t["t"]["body"], "-_", "+/")),
        "alphabet": by(t["enc"], {e: F.lit(a) for e, a in _ALPHABET.items()}),
        "k": by(t["enc"], {e: F.lit(float(len(a))) for e, a in _ALPHABET.items()}),
        "shift": t["n"] * by(t["enc"], {e: F.lit(len(a) * coincidence[e] - 1) for e, a in _ALPHABET.items()}),
        "pq": by(t["enc"], {e: F.lit(_DIGITS[e] / len(a) * (1 - _DIGITS[e] / len(a))) for e, a in _ALPHABET.items()}),
    })
    rows = step(rows, lambda t: {
        "at": F.transform(F.filter(F.split(t["plain"], ""), lambda c: F.length(c) > 0), lambda c: F.instr(t["alphabet"], c) - (t["k"] + 1) / 2),
        "chi": F.greatest(
            t["k"] / t["t"]["n"] * F.aggregate(
                F.transform(
                    F.filter(F.split(t["alphabet"], ""), lambda c: F.length(c) > 0),
                    lambda c: F.length(t["plain"]) - F.length(F.replace(t["plain"], c, F.lit(""))),
                ),
                F.lit(0.0), lambda acc, v: acc + v * v,
            ) - t["t"]["n"], F.lit(1e-9)),
    })

    def result(r: Column) -> Column:
        t = r["t"]
        head, n, k, pq, chi = t["t"]["t"], t["t"]["n"], t["k"], t["pq"], r["chi"]
        free = k - 1
        z_chi = (F.cbrt(chi / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        changes = F.regexp_count(t["plain"], F.lit("(?<=[0-9])[^0-9]|(?<=[^0-9])[0-9]"))
        z_runs = (changes - 2 * pq * (n - 1)) / F.sqrt((n - 1) * 2 * pq * (1 - 2 * pq) + 2 * (n - 2) * (pq - 4 * pq * pq))
        lagged = F.aggregate(
            F.zip_with(F.slice(r["at"], F.lit(1), n - 1), F.slice(r["at"], F.lit(2), n - 1), lambda a, b: a * b),
            F.lit(0.0), lambda acc, v: acc + v,
        )
        z_serial = lagged / ((k * k - 1) / 12) / F.sqrt(n - 1)
        z_prose = (chi - (free + t["shift"])) / F.sqrt(2 * (free + 2 * t["shift"]))
        bin_ = F.least(F.greatest(F.floor(_log10_normal_cdf(z_prose) * -10), F.lit(0)), F.lit(240)).cast("int")
        even = (z_chi <= max_z) & (F.abs(z_runs) <= max_z) & (F.abs(z_serial) <= max_z)
        band = F.least(F.floor(F.log2(n / 20.0) * 2), F.lit(11)).cast("int")
        values = (head["start"], head["end"], t["t"]["enc"], band, F.coalesce(even, F.lit(False)), F.coalesce(bin_, F.lit(0)))
        return F.struct(*(v.alias(name) for name, v in zip(_FOUND, values)))

    return F.transform(rows, result)


def _tokens(docs: DataFrame, text: str, coincidence: dict[str, float], max_z: float) -> DataFrame:
    """Adds ``__secret_tokens``: the tested tokens of each row. A token whose letters and
    digits are of one class only (a word, a number) has no digit runs to test and
    fails the runs test by itself when it is long enough to tell."""
    return docs.withColumn("__secret_hits", _matches(F.coalesce(F.col(text), F.lit("")), TOKEN)).withColumn(
        "__secret_tokens", _tested(F.col("__secret_hits"), coincidence, max_z)
    )


def _clear(tokens: Column, spans: Column) -> Column:
    """The tokens (sorted, apart) that overlap none of the spans (sorted by start):
    among all of them by start, no span before a token ends behind its start, and
    the next span starts at its end or later."""
    far = 1 << 30
    place = lambda x, token: F.struct(x["start"].alias("start"), token.alias("token"), x["end"].alias("end"))
    events = F.array_sort(
        F.concat(F.transform(spans, lambda s: place(s, F.lit(-1))), F.transform(tokens, lambda t, i: place(t, i)))
    )

    def free(events: Column) -> Column:
        ends = F.transform(events, lambda e: F.when(e["token"] < 0, e["end"]).otherwise(0))
        starts = F.reverse(F.transform(events, lambda e: F.when(e["token"] < 0, e["start"]).otherwise(far)))
        before = prefixes(ends, lambda a, b: F.greatest(a, b), F.lit(0), "int")
        after = F.reverse(prefixes(starts, lambda a, b: F.least(a, b), F.lit(far), "int"))
        near = F.zip_with(before, after, lambda a, b: F.struct(a.alias("before"), b.alias("after")))
        seen = F.zip_with(events, near, lambda e, n: F.struct(e.alias("e"), n.alias("n")))
        kept = F.filter(seen, lambda x: (x["e"]["token"] >= 0) & (x["n"]["before"] <= x["e"]["start"]) & (x["n"]["after"] >= x["e"]["end"]))
        return F.transform(kept, lambda x: F.element_at(tokens, x["e"]["token"] + 1))

    return F.when(F.size(spans) == 0, tokens).otherwise(let(events, free))


def discovery_bins(tokens: DataFrame, rate: float) -> dict[tuple[str, int], int]:
    """For each (encoding, length band): the least p bin reported. Benjamini-Hochberg
    on the histogram: bin b stands if 10^(-b/10) <= rate * (tokens in bins >= b) / all,
    its upper edge taken as every member's p-value."""
    rows = (
        tokens.select(F.explode("__secret_tokens").alias("t"))
        .groupBy("t.encoding", "t.band", "t.bin")
        .count()
        .collect()
    )
    families: dict[tuple[str, int], dict[int, int]] = {}
    for encoding, band, bin_, n in rows:
        families.setdefault((encoding, band), {})[bin_] = n
    out = {}
    for family, by_bin in families.items():
        total, above = sum(by_bin.values()), 0
        for b in sorted(by_bin, reverse=True):
            above += by_bin[b]
            if 10 ** (-b / 10) <= rate * above / total:
                out[family] = b
    return out


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    rate: float = 0.01,
    coincidence: dict[str, float] = COINCIDENCE,
    max_z: float = 3.3,
) -> DataFrame:
    """Adds ``base_spans`` and ``spans`` (base and battery), arrays of
    (start, kind number in `KINDS`, end), sorted. ``rate`` is the false-discovery
    rate, ``coincidence`` the chance that two characters of ordinary text are equal."""
    least = discovery_bins(_tokens(docs.select(text), text, coincidence, max_z), rate)
    family = [F.struct(F.lit(e).alias("e"), F.lit(b).alias("b"), F.lit(n).alias("n")) for (e, b), n in sorted(least.items())]
    bars = F.array(*family) if family else F.array().cast("array<struct<e:string,b:int,n:int>>")

    def reported(t: Column) -> Column:
        return t["even"] & F.exists(bars, lambda f: (f["e"] == t["encoding"]) & (f["b"] == t["band"]) & (t["bin"] >= f["n"]))

    random = F.transform(
        _clear(F.col("__secret_reported"), F.col("base_spans")),
        lambda t: F.struct(t["start"].alias("start"), F.lit(RANDOM).alias("kind"), t["end"].alias("end")),
    )
    return (
        _tokens(docs, text, coincidence, max_z)
        .withColumn("__secret_reported", F.filter("__secret_tokens", reported))
        .withColumn("base_spans", _base_spans(F.coalesce(F.col(text), F.lit(""))))
        .withColumn("spans", F.when(F.size("__secret_reported") > 0, F.array_sort(F.concat("base_spans", random))).otherwise(F.col("base_spans")))
        .drop("__secret_hits", "__secret_tokens", "__secret_reported")
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the array's order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def op4_secret_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda no: F.size(F.filter("base_spans", lambda s: s["kind"] == no)).cast("long")
    return scan_secrets(docs).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )
