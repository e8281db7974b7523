from __future__ import annotations

import collections
import math
import re

from tests.llm import brute
from tidemill.llm import urls as U


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = re.search(r"[/?#]", rest)
    host, tail = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "")
    return "".join(c.lower() if c.isascii() else c for c in host), re.split(r"[?#]", tail)[0]


def rule_of(host, path):
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


def shape(s):
    name, dot, rest = s.partition(".")
    varies = re.fullmatch("[0-9]+", name) or (re.fullmatch("[0-9a-fA-F-]{8,}", name) and re.search("[0-9]", name))
    return "*" + dot + rest if varies else s


def judge(urls):
    """The template tree in plain Python."""
    seen = []
    for u in urls:
        host, path = split(u)
        parts = path.split("/", U.LEVELS)
        tpl = ["/".join(shape(x) for x in p.split("/")) for p in parts]
        seen.append([host, path, rule_of(host, path), tpl])
    for level in range(1, U.LEVELS + 1):
        kids = collections.defaultdict(collections.Counter)
        for host, _, _, tpl in seen:
            if len(tpl) > level and tpl[level]:
                kids[host, "/".join(tpl[:level])][tpl[level]] += 1
        wide = {k for k, c in kids.items() if len(c) > U.FAN and sum(c.values()) < U.THIN * len(c)}
        for row in seen:
            tpl = row[3]
            if len(tpl) > level and tpl[level] and (row[0], "/".join(tpl[:level])) in wide:
                row[3] = [*tpl[:level], "*", *tpl[level + 1 :]]
    leaf = collections.defaultdict(lambda: [0, 0])
    for host, _, rule, tpl in seen:
        if rule:
            leaf[host, tuple(tpl)][0] += 1
            leaf[host, tuple(tpl)][1] += rule.verdict == "block"
    kin = collections.defaultdict(list)
    for (host, tpl), (n, b) in leaf.items():
        if len(tpl) > 2:
            kin[host, tpl[:1] + ("",) + tpl[2:]].append((tpl, n, b))
    merged = {}
    for (host, _), members in kin.items():
        if len(members) > 1:
            total = sum(n for _, n, _ in members)
            share = sum(b for *_, b in members) / total
            like = [m for m in members if abs(m[2] / m[1] - share) <= U.ALIKE * math.sqrt(max(share * (1 - share), 1e-9) / m[1])]
            for tpl, *_ in like:
                merged[host, tpl] = (sum(n for _, n, _ in like), sum(b for *_, b in like))
    out = []
    for host, path, rule, tpl in seen:
        n, b = merged.get((host, tuple(tpl)), leaf.get((host, tuple(tpl)), (0, 0)))
        verdict = rule.verdict if rule else "block" if (b + 1) / (n + 2) >= U.PURITY else "allow"
        out.append((host, path, rule.text if rule else None, verdict))
    return out


def check(frame, urls):
    got = [(r["u_id"], (r["host"], r["path"], r["rule"], r["verdict"])) for r in U.judge_urls(frame).collect()]
    assert sorted(map(str, got)) == sorted(map(str, enumerate(judge(urls))))


def test_query_equals_brute_force(spark):
    pages = brute.table("pages", brute.CHECK)
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.op4_urls(spark, brute.CHECK).collect()}
    assert [rows[i] for i in pages.page_id] == judge(list(pages.url))


def test_tree(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Example.COM/en/1", "https://a.example.com/en/2?x#y", "http://www.example.com/en/",
            "http://sub.www.example.com/en/q", "http://x.net", "http://x.net/es/", "http://notcom/x", "http://com/x", "://com/a",
            "http://x.net/a/b/c/d/e/f/g/h/1", "http://É.net/fr/1", "http://x.net/fr/" + "y" * 10_000]
    # A wide, thin level: its children become one template, which the blocked ones then decide for the others.
    urls += [f"http://w.net/es/p{i}" for i in range(50)] + [f"http://w.net/de/{i}" for i in range(5)]
    urls += [f"http://v.net/p{i}/x" for i in range(40)] + ["http://v.net/p1/x"] * 2
    # Siblings of one share are merged; an odd one is not.
    urls += [f"http://s.example.com/{a}/{i}" for a in ("en", "fr", "de") for i in range(6)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    check(frame, urls)
    templates = {r["template"] for r in U.judge_urls(frame).collect()}
    assert "/es/*" in templates and "/{de|fr}/*" in templates
    assert U.judge_urls(frame.limit(0)).count() == 0


def test_a_labelled_template_decides_for_unlabelled_urls(spark):
    rules = (U.Rule("block", "h.org", "/p1"), U.Rule("block", "h.org", "/p2"))
    urls = [f"http://h.org/p{i}/x" for i in range(10, 60)]
    frame = spark.createDataFrame([(i, u, "theirs") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = U.judge_urls(frame, rules=rules).collect()
    assert {r["template"] for r in rows} == {"/*/x"} and {r["verdict"] for r in rows} == {"block"}
