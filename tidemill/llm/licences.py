"""Operator 3. License scan by a positional rare-token index, in built-in expressions only.

Every template is a short wording with mandatory key phrases. The document
frequency of each licence word over all files gives its IDF; a template is
posted in the index under the rarest word of its key phrases, with that
word's offset. A file's occurrences of those highest-IDF words are looked up,
each posting fixes where the template would start, and the template's other
words are intersected at their relative positions. A template is found when
its key phrases stand word for word and the words that stand in place carry
``ENOUGH`` of its IDF.

The index is a short literal (the templates are a written list), so files are
scanned inside their own rows and nothing is shuffled but the licence words'
document counts.

Defined cases: null and empty texts have no words, labels ``''`` and score 0;
rows that repeat count each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import let, open_table

#: What separates words once A-Z are lower-cased: ASCII but letters and digits.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ENOUGH = 0.8

# The base phrases and their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Wordings of public licences; a key phrase is marked by brackets.
WORDINGS = (
    ("apache-2.0", "licensed under the [apache license version 2 0]"),
    ("gpl-2.0", "under the terms of the [gnu general public license] as published by the free software foundation either [version 2]"),
    ("gpl-3.0", "licensed under the [gnu general public license version 3]"),
    ("lgpl", "[gnu lesser general public license]"),
    ("agpl", "[gnu affero general public license]"),
    ("cc-by-sa", "licensed under [cc by sa]"),
    ("cc-by-nc", "licensed under [cc by nc]"),
    ("cc-by", "[creative commons attribution] 4 0 international"),
    ("cc0", "[cc0 1 0] universal"),
    ("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this software"),
    ("bsd", "[redistribution and use in source and binary forms] with or without modification are permitted"),
    ("isc", "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "subject to the terms of the [mozilla public license] v 2 0"),
    ("unlicense", "this is free and unencumbered software [released into the public domain]"),
)


def file_words(text: Column) -> Column:
    """Words of a text, lower-cased; a text's non-ASCII characters belong to words."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAKS, -1), "")


def templates() -> list[dict]:
    """Label, words, which of them are mandatory, and whether the template is a base phrase."""
    out = [{"label": label, "words": text.split(), "key": [True] * len(text.split()), "base": True} for label, text in PHRASES]
    for label, text in WORDINGS:
        words, key, on = [], [], False
        for w in text.split():
            on = on or w.startswith("[")
            words.append(w.strip("[]"))
            key.append(on)
            on = on and not w.endswith("]")
        out.append({"label": label, "words": words, "key": key, "base": False})
    return out


def document_counts(docs: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Files, and in how many of them each licence word stands; over all whole texts."""
    vocabulary = sorted({w for t in templates() for w in t["words"]})
    known = F.array(*[F.lit(w) for w in vocabulary])
    found = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(known, file_words(F.col(text))))).alias("w"))
    rows = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}  # one row a licence word
    return rows.get("", 0), {w: rows.get(w, 0) for w in vocabulary}


def postings(files: int, counts: dict[str, int]) -> dict[str, list[dict]]:
    """Anchor word -> templates posted under it, with the anchor's offset and each word's share of the template's IDF."""
    idf = {w: math.log((files + 1) / (n + 1)) + 1.0 for w, n in counts.items()}
    out: dict[str, list[dict]] = {}
    for t in templates():
        total = math.fsum(idf[w] for w in t["words"])
        at = max((i for i, k in enumerate(t["key"]) if k), key=lambda i: (idf[t["words"][i]], -i))
        entry = {"label": t["label"], "base": t["base"], "off": at, "words": t["words"], "key": t["key"], "part": [idf[w] / total for w in t["words"]]}
        out.setdefault(t["words"][at], []).append(entry)
    return out


_ENTRY = "word: string, label: string, base: boolean, off: int, words: array<string>, key: array<boolean>, part: array<double>"
_FOUND = "array<struct<label: string, base: boolean, start: bigint, keys: boolean, share: double>>"


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, and per file: base places (count, first and last word), base labels, labels, score."""
    index = postings(*document_counts(docs, text))
    anchors = sorted(index)
    entries = [e | {"word": w} for w in anchors for e in index[w]]
    listed = F.from_json(F.lit(json.dumps(entries)), f"array<struct<{_ENTRY}>>")

    def candidates(words: Column) -> Column:
        def at(place: Column) -> Column:
            here = F.get(words, place)

            def entry(e: Column) -> Column:
                start = place - e["off"]
                stands = F.transform(e["words"], lambda x, k: F.coalesce(F.get(words, start + k) == x, F.lit(False)))
                return let(
                    stands,
                    lambda s: F.struct(
                        e["label"].alias("label"),
                        e["base"].alias("base"),
                        start.cast("long").alias("start"),
                        F.forall(F.zip_with(s, e["key"], lambda a, k: a | ~k), lambda x: x).alias("keys"),
                        F.aggregate(F.zip_with(s, e["part"], lambda a, p: F.when(a, p).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x).alias("share"),
                    ),
                )

            return F.transform(F.filter(listed, lambda e: e["word"] == here), entry)

        places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(anchors))
        none = F.lit(None).cast(_FOUND)
        overlap = F.arrays_overlap(words, F.array(*[F.lit(a) for a in anchors]))
        return F.struct(
            F.size(words).cast("long").alias("n"),
            F.when((F.size(words) > 0) & overlap, F.flatten(F.transform(places, at))).otherwise(none).alias("c"),
        )

    rows = docs.select(F.col(doc_id).alias("l_id"), let(file_words(F.col(text)), candidates).alias("m"))
    seen = F.coalesce(F.col("m.c"), F.from_json(F.lit("[]"), _FOUND))

    def told(c: Column) -> Column:
        found = F.filter(c, lambda e: e["keys"] & (e["share"] >= ENOUGH))
        base = F.filter(found, lambda e: e["base"])
        joined = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda e: e["label"]))), ",")
        return F.struct(
            F.size(base).cast("long").alias("n_base"),
            F.array_min(F.transform(base, lambda e: e["start"])).alias("first_word"),
            F.array_max(F.transform(base, lambda e: e["start"])).alias("last_word"),
            joined(base).alias("base_labels"),
            joined(found).alias("labels"),
            F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform(c, lambda e: e["share"])), F.lit(0.0))).alias("score"),
        )

    return rows.select("l_id", F.col("m.n").alias("n_words"), let(seen, told).alias("t")).select(
        "l_id", "n_words", "t.n_base", "t.first_word", "t.last_word", "t.base_labels", "t.labels", "t.score"
    )


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places, labels and score of every document."""
    return scan(open_table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("l_id", "doc_id")
