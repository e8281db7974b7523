"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS n,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source),
lev AS (
  SELECT *, 2.0::DOUBLE * n / w AS ratio,
         1.5::DOUBLE * sum(n) OVER () - 2.0::DOUBLE * coalesce(sum(n) OVER (ORDER BY 2.0::DOUBLE * n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
         sum(w) OVER (ORDER BY 2.0::DOUBLE * n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS tw
  FROM src),
lam AS (SELECT b, tw FROM lev WHERE b * w / tw <= 2.0::DOUBLE * n ORDER BY ratio, source LIMIT 1),
tgt AS (
  SELECT source, n, CASE WHEN (SELECT b FROM lam) * w / (SELECT tw FROM lam) > 2.0::DOUBLE * n THEN 2.0::DOUBLE * n
                         ELSE (SELECT b FROM lam) * w / (SELECT tw FROM lam) END AS target
  FROM src),
plan AS (
  SELECT *, CASE WHEN n = 0 THEN 0 ELSE least(2, floor(target / n)) END::BIGINT AS whole FROM tgt),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, h) AS i FROM sized),
cum AS (
  SELECT s.doc_id, s.size, p.n, p.target, p.whole, s.h, p.target - p.whole * p.n AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.i) AS c,
         s.size AS own
  FROM numbered s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, n AS source_size, target::DOUBLE AS target,
       (size * (whole + CASE WHEN rest > 0 AND (c < rest OR (c - own < rest AND c - rest <= rest - (c - own))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM cum
"""

REPEATS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS k FROM d, unnest(range(1, len(ws) - 33)) t(i)),
twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + o AS p FROM win JOIN twice USING (k), range(35) t(o)),
words AS (SELECT r, p, ws[p] AS w FROM d, unnest(range(1, len(ws) + 1)) t(p)),
kept AS (SELECT r, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


RANKED = r"""
WITH words AS (
  SELECT d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)),
tf AS (SELECT d, doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
size AS (SELECT d, sum(tf)::BIGINT AS n FROM tf GROUP BY d),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM size),
weight AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w
           FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), total),
gain AS (SELECT d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))) AS g
         FROM tf JOIN size USING (d) JOIN weight USING (term), total),
mention AS (
  SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
score AS (SELECT item_id, text, d, doc_id, sum(g)::BIGINT AS score FROM mention JOIN gain USING (term) GROUP BY ALL HAVING sum(g) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST, d) AS rank FROM score)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


NEGATIVES = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT DISTINCT id, label, v FROM e WHERE id % 100 = 0),
s AS (SELECT a.id AS anchor_id, a.v AS av, a.label AS al, e.r, e.id, e.label, list_dot_product(a.v, e.v)::BIGINT AS score FROM a, e),
p AS (SELECT * FROM s WHERE label = al AND id <> anchor_id
      QUALIFY row_number() OVER (PARTITION BY anchor_id, av, al ORDER BY score DESC, id, r) <= 5),
n AS (SELECT p.anchor_id, p.av, p.al, p.r AS pr, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.av, p.al, p.r ORDER BY s.score DESC, s.id, s.r) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.av = p.av AND s.al = p.al
      WHERE s.label <> p.al AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def _urls(levels: int = 6, fan: int = 32, thin: float = 4.0) -> str:
    """The template tree: one pair of expressions a level, then merging and purity."""
    shaped = (
        "CASE WHEN regexp_full_match(regexp_extract(x, '^([^.]*)', 1), '[0-9]+') "
        "OR (regexp_full_match(regexp_extract(x, '^([^.]*)', 1), '[0-9a-fA-F-]{8,}') AND regexp_matches(regexp_extract(x, '^([^.]*)', 1), '[0-9]')) "
        "THEN '*' || regexp_extract(x, '^[^.]*(.*)$', 1) ELSE x END"
    )
    shapes = f"list_transform(string_split(path, '/'), lambda x: {shaped})"
    rules = [("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("allow", "com", "/")]
    rules.sort(key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, rules, strict=True)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, rules, strict=True)) + " END"
    parts = [
        r"""
WITH cut AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages)""",
        f"""
seen AS (
  SELECT page_id, host, path, {rule} AS rule, {verdict} AS said, {shapes} AS all_parts FROM cut)""",
        f"""
seen2 AS (
  SELECT *, CASE WHEN len(all_parts) > {levels + 1}
                 THEN list_concat(all_parts[1:{levels}], [array_to_string(all_parts[{levels + 1}:], '/')]) ELSE all_parts END AS branch
  FROM seen)""",
        """
b1 AS (SELECT host, branch, branch AS tpl, count(*) AS n, count(said) AS l, count(*) FILTER (WHERE said = 'block') AS b
       FROM seen2 GROUP BY host, branch)""",
    ]
    for level in range(2, levels + 2):
        prior, child = f"b{level - 1}", f"tpl[{level}]"
        parent = f"array_to_string(tpl[1:{level - 1}], '/')"
        parts.append(
            f"""
w{level} AS (
  SELECT host, parent FROM (SELECT host, {parent} AS parent, {child} AS child, sum(n) AS n FROM {prior}
                            WHERE {child} <> '' GROUP BY ALL)
  GROUP BY host, parent HAVING count(*) > {fan} AND sum(n) < {thin} * count(*)),
b{level} AS (
  SELECT p.host, branch, CASE WHEN w.host IS NOT NULL AND {child} <> ''
                              THEN list_concat(tpl[1:{level - 1}], list_concat(['*'], tpl[{level + 1}:])) ELSE tpl END AS tpl, n, l, b
  FROM {prior} p LEFT JOIN w{level} w ON w.host = p.host AND w.parent = {parent})"""
        )
    parts.append(
        f"""
leaf AS (
  SELECT host, tpl, sum(l) AS l, sum(b) AS b,
         CASE WHEN len(tpl) > 2 THEN list_concat(tpl[1:1], list_concat([''], tpl[3:])) END AS kin
  FROM b{levels + 1} GROUP BY host, tpl),
pool AS (SELECT host, kin, sum(b) / sum(l) AS share, count(*) AS k FROM leaf WHERE kin IS NOT NULL AND l > 0 GROUP BY host, kin),
alike AS (
  SELECT f.*, coalesce(l > 0 AND k > 1 AND abs(b / l - share) <= 1.96 * sqrt(greatest(share * (1 - share), 1e-9) / l), false) AS same
  FROM leaf f LEFT JOIN pool USING (host, kin)),
merged AS (SELECT host, kin, sum(l) AS ml, sum(b) AS mb, '{{' || array_to_string(list_sort(list_distinct(list(tpl[2]))), '|') || '}}' AS firsts
           FROM alike WHERE same GROUP BY host, kin),
done AS (
  SELECT a.host, a.tpl, array_to_string(CASE WHEN same THEN list_concat(a.tpl[1:1], list_concat([firsts], a.tpl[3:])) ELSE a.tpl END, '/') AS template,
         (CASE WHEN same THEN mb ELSE b END + 1.0::DOUBLE) / (CASE WHEN same THEN ml ELSE l END + 2.0::DOUBLE) AS purity
  FROM alike a LEFT JOIN merged USING (host, kin))
SELECT page_id, s.host, path, rule, coalesce(said, CASE WHEN purity >= 0.8 THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM seen2 s JOIN b{levels + 1} t ON s.host = t.host AND s.branch = t.branch JOIN done d ON d.host = t.host AND d.tpl = t.tpl
"""
    )
    return ",".join(parts)


ORACLE = {
    "op4_urls": _urls(),
    "op8_substrings": REPEATS,
    "op9_mix_sources": MIX,
    "op11_search": RANKED,
    "op12_negatives": NEGATIVES,
}
