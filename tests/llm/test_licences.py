from __future__ import annotations

import re

from tests.llm import brute
from tidemill.llm import licences as L

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    w = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for label, p in L.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def labels(text, files, counts):
    """Every template at every place, without the index."""
    w = WORD.findall((text or "").translate(LOWER))
    found, best = set(), 0.0
    for entries in L.postings(files, counts).values():
        for e in entries:
            for start in range(-len(e["words"]), len(w)):
                stands = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(e["words"])]
                if stands[e["off"]]:
                    share = sum(p for s, p in zip(stands, e["part"]) if s)
                    best = max(best, share)
                    if share >= L.ENOUGH and all(s or not k for s, k in zip(stands, e["key"])):
                        found.add(e["label"])
    return ",".join(sorted(found)), min(1.0, best)


def check(spark, frame, id_col="doc_id"):
    files, counts = L.document_counts(frame)
    texts = [r["text"] for r in frame.select("doc_id", "text").collect()]
    rows = L.scan(frame).collect()
    want = sorted((*map(str, (*base(t), labels(t, files, counts)[0])), round(labels(t, files, counts)[1], 9)) for t in texts)
    keys = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    got = sorted((*(str(r[k]) for k in keys), round(r["score"], 9)) for r in rows)
    assert got == want


def test_query_equals_brute_force(spark):
    check(spark, spark.read.parquet(f"{brute.SMALL}/documents.parquet"))
    assert L.op3_licences(spark, brute.SMALL).count() == len(brute.table("documents"))


def test_texts_of_licences(spark, edge, empty):
    texts = [
        "Licensed under the Apache License, Version 2.0 and again apache license",
        "GNU GENERAL PUBLIC LICENSE GNU General Public License",
        "gnu general public licence",  # spelt otherwise: no phrase
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistribution and use in source and binary forms, with or xx modification, are permitted",
        "redistribution and use in source",
        "CC BY CC BY-SA 4.0, licensed under CC BY-NC",
        "the mit license the MIT LİCENSE mit-license",
        None,
        "",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(spark, frame)
    rows = {r["l_id"]: r for r in L.scan(frame).collect()}
    assert rows[0]["labels"] == "apache,apache-2.0" and rows[3]["labels"] == "bsd" and rows[4]["labels"] == "bsd"
    assert rows[2]["n_base"] == 0 and rows[8]["labels"] == "" and rows[5]["labels"] == "" and rows[5]["score"] < 0.8
    check(spark, edge)
    assert L.scan(empty).count() == 0
