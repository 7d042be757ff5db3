"""What the tests of this folder share."""

import re

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like outputs and helpers of the operators.
CLASHES = ["shard", "slot", "score", "labels", "hits", "items", "rejected", "fingerprint", "doc", "key", "row", "removed", "spans", "name", "_row", "node", "root"]


def prose(seed: int, n: int) -> str:
    """Text of ``n`` made-up words, by a small congruence generator."""
    x, words = seed * 7919 + 13, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        words.append("".join("bdklmnrst"[x // 7**k % 9] + "aeiou"[x // 11**k % 5] for k in range(2 + x % 3)))
    return " ".join(words)


def framed(spark, rows):
    """Documents with clashing extra columns."""
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("mine"))
    return df


WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {ord(a): ord(a) + 32 for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def fold(text):
    return (text or "").translate(FOLD)


def words(text):
    return WORD.findall(fold(text))


class Union:
    """Union-find whose root is the smallest member."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a
