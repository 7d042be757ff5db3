"""License scan by ordered signature rules (Spark expressions only).

A text is folded to words (`WORD` below) joined by single spaces. Rules are
regexes over that string, each with a label, a priority and a keyword. A text
without any of the few ``GATES`` substrings runs no rule at all; in the others
a rule's regex runs only where the text holds the rule's keyword. Detections
are word intervals. One is suppressed when an interval that contains it was
made by a stronger rule (higher priority, then the longer interval, then the
earlier rule), so "gnu lesser general public license" is not also a GPL hit.

Everything is one projection over the row: no shuffle, join or Python worker. Work on a
text grows with its words, for each rule that matches in it: a detection is compared
only with its neighbours in the order of their places, as far as the text's longest
detection reaches. The detections of one text are held together.

Defined results: null, empty and word-free texts have no detections (no
labels, score 0); repeated places each count; columns of the input are kept
and those named like an output are replaced; an empty table stays empty.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stayledger.llm.frames import fold_ascii, let, part_of, table

#: Fixed values of the contract: the phrases all of whose places count.
BASE_PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

#: Every match of every rule holds one of these (tests/llm checks the rules).
GATES = ["licen", "spdx", "cc by", "public domain", "creative commons", "hereby granted", "redistribution and use", "all rights reserved"]

#: label, keyword, name as a regex over folded words.
NAMES = [
    ("mit", "mit", "(?:mit|x11 mit)"),
    ("mit", "expat", "expat"),
    ("mit-0", "mit", "mit (?:0|no attribution)"),
    ("apache-1.1", "apache", "apache (?:software )?(?:license )?(?:version )?1 1"),
    ("apache-2", "apache", "apache (?:software )?(?:license )?(?:version |v )?2(?: 0)?"),
    ("bsd-1-clause", "bsd", "bsd 1 clause"),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|simplified bsd|freebsd|2 clause bsd)"),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|new bsd|modified bsd|revised bsd|3 clause bsd)"),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|original bsd|4 clause bsd)"),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd|bsd zero clause)"),
    ("isc", "isc", "isc"),
    ("gpl-1", "gpl", "(?:gnu )?gpl (?:v|version )?1(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gpl", "(?:gnu )?gpl ?(?:v|version )?2(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gpl", "(?:gnu )?gpl ?(?:v|version )?3(?: 0)?(?: only| or later)?"),
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("gpl", "gnu", "gnu general public"),
    ("lgpl-2", "lgpl", "(?:gnu )?lgpl ?(?:v|version )?2(?: 0)?(?: only| or later)?"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl ?(?:v|version )?2 1(?: only| or later)?"),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl ?(?:v|version )?3(?: 0)?(?: only| or later)?"),
    ("lgpl", "lesser", "gnu lesser general public"),
    ("lgpl", "library", "gnu library general public"),
    ("agpl-3", "agpl", "(?:gnu )?agpl ?(?:v|version )?3(?: 0)?(?: only| or later)?"),
    ("agpl", "affero", "gnu affero general public"),
    ("gfdl", "documentation", "gnu free documentation"),
    ("gfdl", "fdl", "(?:gnu )?(?:gfdl|fdl)(?: 1 [123])?(?: only| or later)?"),
    ("mpl-1.1", "mpl", "mpl (?:version )?1 1"),
    ("mpl-2.0", "mpl", "mpl (?:version )?2(?: 0)?"),
    ("mpl", "mozilla", "mozilla public"),
    ("epl-1.0", "epl", "epl (?:version )?1(?: 0)?"),
    ("epl-2.0", "epl", "epl (?:version )?2(?: 0)?"),
    ("epl", "eclipse", "eclipse public"),
    ("edl", "eclipse", "eclipse distribution"),
    ("cddl", "cddl", "cddl(?: 1 [01])?"),
    ("cddl", "distribution", "common development and distribution"),
    ("cpl", "common", "common public"),
    ("eupl", "eupl", "eupl(?: 1 [012])?"),
    ("eupl", "european", "european union public"),
    ("osl-3.0", "open", "open software(?: 3 0)?"),
    ("afl", "academic", "academic free"),
    ("artistic-1", "artistic", "artistic(?: license)? 1(?: 0)?"),
    ("artistic-2", "artistic", "artistic(?: license)? 2(?: 0)?"),
    ("artistic", "artistic", "artistic"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("libpng", "libpng", "libpng(?: 2 0)?"),
    ("bsl-1.0", "boost", "boost (?:software )?(?:license )?(?:version )?1(?: 0)?"),
    ("bsl-1.0", "bsl", "bsl 1 0"),
    ("busl", "business", "business source"),
    ("sspl", "sspl", "sspl(?: 1 0)?"),
    ("sspl", "server", "server side public"),
    ("elastic", "elastic", "elastic(?: license)?(?: 2 0)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc", "cc by(?: [1234] [05])?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1234] [05])?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1234] [05])?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1234] [05])?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1234] [05])?"),
    ("odbl", "odbl", "odbl(?: 1 0)?"),
    ("odbl", "database", "open (?:data commons open )?database"),
    ("pddl", "pddl", "pddl(?: 1 0)?"),
    ("odc-by", "odc", "odc by(?: 1 0)?"),
    ("ofl-1.1", "ofl", "(?:sil )?ofl(?: 1 1)?"),
    ("ofl-1.1", "font", "(?:sil )?open font"),
    ("psf", "python", "python software foundation"),
    ("psf", "psf", "psf(?: 2 0)?"),
    ("php", "php", "php(?: 3 0 1?)?"),
    ("ruby", "ruby", "ruby"),
    ("postgresql", "postgresql", "postgresql"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa"),
    ("ms-pl", "microsoft", "microsoft public"),
    ("ms-rl", "microsoft", "microsoft reciprocal"),
    ("openssl", "openssl", "openssl"),
    ("vim", "vim", "vim"),
    ("beerware", "beerware", "beerware"),
    ("upl", "universal", "universal permissive"),
    ("mulan-psl-2", "mulan", "mulan permissive software(?: license)?(?: v2| version 2)?"),
    ("cecill", "cecill", "cecill(?: [bc])?(?: 2 [01])?"),
    ("lppl", "latex", "latex project public"),
    ("rail", "rail", "(?:open |big ?science |creativeml )*rail(?: m)?"),
    ("llama", "llama", "llama [0-9]+(?: [0-9]+)? community"),
]

#: Ways a text names its license; N stands for a name. Priority in front.
FRAMES = [
    (90, "spdx license identifier (?:[^ ]+ (?:or|and) )?N"),
    (80, "licen[sc]ed (?:[^ ]+ )?under (?:the )?(?:terms of )?(?:the )?N(?: public)?(?: software)?(?: licen[sc]e)?(?: version [0-9]+(?: [0-9]+)?)?"),
    (70, "under (?:the )?(?:terms of )?(?:the )?N(?: public)?(?: software)? licen[sc]e(?: version [0-9]+(?: [0-9]+)?)?"),
    (60, "N(?: public)?(?: software)? licen[sc]e(?: v ?[0-9]+| version [0-9]+(?: [0-9]+)?)?"),
    (50, "licen[sc]e (?:is |type |name |as )?(?:the )?N"),
]

#: label, priority, keyword, regex: sentences and marks of one license.
SENTENCES = [
    ("mit", 95, "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", 95, "permission", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("bsd-2-clause", 75, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 95, "endorse", "redistribution and use in source and binary forms(?: [^ ]+){1,120} may be used to endorse or promote products"),
    ("apache-2", 95, "apache", "http www apache org licenses license 2 0"),
    ("apache-2", 85, "apache", "apache org licenses license 2 0(?: txt| html)?"),
    ("gpl-2", 92, "version 2", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 2"),
    ("gpl-3", 92, "version 3", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 3"),
    ("lgpl-2.1", 93, "version 2 1", "gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 2 1"),
    ("lgpl-3", 93, "version 3", "gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 3"),
    ("agpl-3", 93, "version 3", "gnu affero general public license(?: as published by the free software foundation)?(?: either)? version 3"),
    ("mpl-2.0", 95, "mozilla", "subject to the terms of the mozilla public license v(?:ersion)? ?2 0"),
    ("epl-2.0", 92, "eclipse", "eclipse public license (?:v |version )?2 0"),
    ("unlicense", 95, "unencumbered", "free and unencumbered software released into the public domain"),
    ("public-domain", 65, "public domain", "(?:released into|dedicated to|placed in|in) the public domain"),
    ("cc0", 92, "cc0", "creative commons cc0(?: 1 0)?(?: universal)?"),
    ("cc0", 92, "zero", "creative commons zero(?: 1 0)?(?: universal)?"),
    ("cc-by", 85, "attribution", "creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?"),
    ("cc-by-sa", 86, "alike", "creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?"),
    ("cc-by-nd", 86, "deriv", "creative commons attribution no ?deriv(?:ative)?s?(?: [1234] [05])?"),
    ("cc-by-nc", 86, "commercial", "creative commons attribution non ?commercial(?: [1234] [05])?"),
    ("cc-by-nc-sa", 87, "alike", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?"),
    ("cc-by-nc-nd", 87, "commercial", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?"),
    ("proprietary", 40, "rights", "all rights reserved"),
    ("cc-by", 55, "cc", "cc by(?: [1234] [05])?"),
    ("cc-by-sa", 56, "cc", "cc by sa(?: [1234] [05])?"),
    ("cc-by-nd", 56, "cc", "cc by nd(?: [1234] [05])?"),
    ("cc-by-nc-sa", 57, "cc", "cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", 57, "cc", "cc by nc nd(?: [1234] [05])?"),
]


def rules() -> list[dict]:
    """The ordered rules: base phrases first, then sentences, then every name in
    every frame."""
    out = [{"label": label, "priority": 100, "keyword": phrase, "body": phrase} for label, phrase in BASE_PHRASES]
    out += [{"label": a, "priority": p, "keyword": k, "body": rx} for a, p, k, rx in SENTENCES]
    out += [
        {"label": label, "priority": p, "keyword": k, "body": frame.replace("N", f"(?:{name})", 1)}
        for p, frame in FRAMES
        for label, k, name in NAMES
    ]
    return [r | {"rule": i, "regex": f"(?<= )(?:{r.pop('body')})(?= )"} for i, r in enumerate(out)]


_RULE = "array<struct<label:string,priority:int,keyword:string,rule:int,regex:string>>"


def folded_words(text: Column) -> Column:
    """The words of ``text``, lower-cased, as `` w1 w2 ... wn `` (one space if none)."""
    folded = F.regexp_replace(fold_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.ltrim(F.concat(F.rtrim(folded), F.lit(" "))))


def _places(words: Column, rule: Column) -> Column:
    """One struct for each match: the match is marked in the words, then found by word number."""
    marked = F.split(F.regexp_replace(words, rule["regex"], F.lit("\x01$0\x02")), " ", -1)
    at = lambda hit: F.filter(F.transform(marked, lambda w, i: F.when(hit(w), i)), lambda i: i.isNotNull())
    return F.zip_with(
        at(lambda w: F.startswith(w, F.lit("\x01"))),
        at(lambda w: F.endswith(w, F.lit("\x02"))),
        lambda a, b: F.struct(
            (a - 1).cast("long").alias("first"),
            b.cast("long").alias("end"),
            rule["label"].alias("label"),
            rule["priority"].alias("priority"),
            rule["rule"].alias("rule"),
        ),
    )


_BLOCK = 64


def _by_place(d: Column) -> Column:
    """A detection for the sweep: sorted by place, its strength one number (priority, then
    length, then the earlier rule)."""
    strength = (d["priority"].cast("long") * (1 << 40)) + (d["end"] - d["first"]) * (1 << 12) - d["rule"]
    return F.struct(
        d["first"].alias("first"), (-d["end"]).alias("back"), strength.alias("strength"),
        d["end"].alias("end"), d["label"].alias("label"), d["priority"].alias("priority"), d["rule"].alias("rule"),
    )


def _standing(placed: Column, reach: Column) -> Column:
    """The detections in no stronger one, of detections sorted by place, none longer
    than ``reach``. One that contains another starts at most ``reach`` words before it
    and not behind it: it stands in the block of its neighbours, the block before or the one
    after. Where more than a block of them starts within reach, all are looked at."""
    n = F.size(placed)
    starts = F.sequence(F.lit(0), ((n - 1) / _BLOCK).cast("int"))
    at = lambda i: F.get(placed, i)["first"]

    def block(i: Column, reach: Column) -> Column:
        low = F.greatest((i - 1) * _BLOCK, F.lit(0))
        first, last = at(i * _BLOCK), at(F.least((i + 1) * _BLOCK, n) - 1)
        enough = (low == 0) | (at(low - 1) < first - reach)
        enough = enough & F.coalesce(at(low + 3 * _BLOCK) > last, F.lit(True))
        near = F.when(enough, part_of(placed, low, 3 * _BLOCK)).otherwise(placed)

        def standing(near: Column) -> Column:
            return F.filter(
                part_of(placed, i * _BLOCK, _BLOCK),
                lambda d: ~F.exists(near, lambda e: (e["strength"] > d["strength"]) & (e["first"] <= d["first"]) & (e["end"] >= d["end"])),
            )

        return let(near, standing)

    # bound first: a column named once is worked out where it is used, here for every block
    kept = let(reach, lambda reach: F.flatten(F.transform(starts, lambda i: block(i, reach))))
    return F.transform(kept, lambda d: F.struct(*(d[c].alias(c) for c in ("first", "end", "label", "priority", "rule"))))


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words``, ``detections`` (places that stand, with label, word
    interval [first, end) and priority), ``base`` (all places of the base
    phrases), ``labels`` and ``score`` (the strongest standing priority / 100)."""
    ruleset = F.from_json(F.lit(json.dumps(rules())), _RULE)
    gated = F.lit(False)
    for g in GATES:
        gated = gated | F.contains(F.col("__license_words"), F.lit(g))
    running = F.filter(
        ruleset, lambda r: F.contains(F.col("__license_words"), r["keyword"]) & F.regexp(F.col("__license_words"), r["regex"])
    )
    found = F.flatten(F.transform(running, lambda r: _places(F.col("__license_words"), r)))
    none = F.array().cast("array<struct<first:bigint,end:bigint,label:string,priority:int,rule:int>>")
    placed = F.array_sort(F.transform("__license_found", _by_place))
    n = F.length("__license_words") - F.length(F.replace("__license_words", F.lit(" "), F.lit(""))) - 1
    return (
        docs.withColumn("__license_words", folded_words(F.col(text)))
        .withColumn("__license_found", F.when(gated, found).otherwise(none))
        .withColumn("n_words", F.greatest(n, F.lit(0)).cast("long"))
        .withColumn("base", F.filter("__license_found", lambda d: d["priority"] == 100))
        .withColumn("__license_placed", F.when(F.size("__license_found") > 1, placed))
        .withColumn("__license_reach", F.array_max(F.transform("__license_placed", lambda d: d["end"] - d["first"])))
        .withColumn(
            "detections",
            F.when(F.size("__license_found") < 2, F.col("__license_found"))
            .otherwise(_standing(F.col("__license_placed"), F.col("__license_reach"))),
        )
        .withColumn(
            "labels",
            F.array_sort(F.array_distinct(F.transform(F.concat("base", "detections"), lambda d: d["label"]))),
        )
        .withColumn(
            "score",
            F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])) / 100.0, F.lit(0.0)),
        )
        .drop("__license_words", "__license_found", "__license_placed", "__license_reach")
    )


def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.transform("base", lambda d: d["first"])
    return scan_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(base).alias("first_word"),
        F.array_max(base).alias("last_word"),
        F.array_join(
            F.array_sort(F.array_distinct(F.transform("base", lambda d: d["label"]))), ","
        ).alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.size("detections").cast("long").alias("n_detections"),
        F.col("score").cast("double").alias("score"),
    )
