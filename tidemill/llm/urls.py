"""Operator 4. URL filter by a path-template tree.

Rules (host and path prefix) give the labels. Per host, the urls form a tree
of path segments. Segments that vary are generalised, by shape (numbers, hex
runs, numbers with an extension) and by count (a level whose children are
many and thin becomes a wildcard). Sibling branches whose shares of blocked
urls cannot be told apart are merged. A template is rejected when its
smoothed share of blocked labelled urls reaches ``PURITY``.

Every step works on counts by (host, branch); urls only meet their branch in
one last join, so a hot host costs its number of branches, not of urls.

Defined cases: a null url and one without ``://`` have an empty host and an
empty path, and are judged as a branch of that host; rows that repeat count
each; a template without labelled urls has purity 0.5 and is allowed; path
segments beyond ``LEVELS`` are one last segment, generalised by shape; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import open_table, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LEVELS = 6
#: A level is a wildcard when it has more than FAN children with fewer than THIN urls each on average.
FAN, THIN = 32, 4.0
SMOOTH, PURITY = 1.0, 0.8  # add-one smoothing of both labels
ALIKE = 1.96  # branches closer than so many standard errors to their siblings' pooled share are merged
WILD = "*"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. ``rules`` is a short list written by hand."""
    found = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def segment_shape(segment: Column) -> Column:
    """A segment that varies by its look: digits, hex runs with a digit, and either with an extension."""
    name = F.regexp_extract(segment, r"^([^.]*)", 1)
    rest = F.regexp_extract(segment, r"^[^.]*(.*)$", 1)
    varies = name.rlike(r"^[0-9]+$") | (name.rlike(r"^[0-9a-fA-F-]{8,}$") & name.rlike("[0-9]"))
    return F.when(varies, F.concat(F.lit(WILD), rest)).otherwise(segment)


def branch_of(path: Column) -> Column:
    """The path's segments by shape; ``LEVELS`` of them, what follows joined into the last."""
    parts = F.transform(F.split(path, "/", LEVELS + 1), lambda s: s)
    return F.transform(parts, lambda s: F.when(s.contains("/"), F.array_join(F.transform(F.split(s, "/"), segment_shape), "/")).otherwise(segment_shape(s)))


def _wildcards(branches: DataFrame) -> DataFrame:
    """Level by level, replace the children of wide, thin levels by a wildcard; one row per branch stays one row.

    A level that changes something is written out, so that the next one's plan starts from a table.
    """
    deepest = branches.agg(F.max(F.size("u_tpl"))).first()[0] or 0
    for level in range(2, deepest + 1):
        child = F.get("u_tpl", F.lit(level - 1))
        parent = F.concat_ws("/", F.slice("u_tpl", 1, level - 1))
        here = branches.withColumn("u_parent", parent).withColumn("u_child", child)
        named = F.col("u_child").isNotNull() & (F.col("u_child") != "")
        kids = here.filter(named).groupBy("u_host", "u_parent", "u_child").agg(F.sum("u_n").alias("n"))
        wide = (
            kids.groupBy("u_host", "u_parent")
            .agg(F.count("*").alias("k"), F.sum("n").alias("n"))
            .filter((F.col("k") > FAN) & (F.col("n") < THIN * F.col("k")))
            .select("u_host", "u_parent", F.lit(True).alias("u_wide"))
        )
        wide = stored(wide, "url-wide")
        if wide.isEmpty():
            continue
        turned = F.concat(F.slice("u_tpl", 1, level - 1), F.array(F.lit(WILD)), F.slice("u_tpl", level + 1, LEVELS + 1))
        tpl = F.when(F.col("u_wide") & named, turned).otherwise(F.col("u_tpl"))
        branches = stored(here.join(wide, ["u_host", "u_parent"], "left").withColumn("u_tpl", tpl).select(*branches.columns), "url-branches")
    return branches


def template_purity(urls: DataFrame) -> DataFrame:
    """(u_host, u_branch) -> template, labelled and blocked urls of it, purity. ``urls``: u_host, u_branch, u_label (1 block, 0 allow, null)."""
    branches = urls.groupBy("u_host", "u_branch").agg(
        F.count("*").alias("u_n"), F.count("u_label").alias("u_l"), F.coalesce(F.sum("u_label"), F.lit(0)).cast("long").alias("u_b")
    )
    branches = stored(branches.withColumn("u_tpl", F.col("u_branch")), "url-branches")
    named = _wildcards(branches).withColumn("u_name", F.array_join("u_tpl", "/"))
    leaves = named.groupBy("u_host", "u_name").agg(F.first("u_tpl").alias("u_tpl"), F.sum("u_l").alias("u_l"), F.sum("u_b").alias("u_b"))
    leaves = stored(leaves, "url-leaves")
    # Siblings differ in one literal segment: the first below the root, where sites keep sections and languages.
    first = F.get("u_tpl", F.lit(1))
    kin = F.concat(F.slice("u_tpl", 1, 1), F.array(F.lit("")), F.slice("u_tpl", 3, LEVELS + 1))
    kin = F.when(F.size("u_tpl") > 2, F.array_join(kin, "/"))
    tested = leaves.withColumn("u_kin", kin).withColumn("u_first", first)
    pool = tested.filter("u_kin IS NOT NULL AND u_l > 0").groupBy("u_host", "u_kin").agg(
        F.sum("u_l").alias("p_l"), F.sum("u_b").alias("p_b"), F.count("*").alias("p_k")
    )
    both = tested.join(pool, ["u_host", "u_kin"], "left")
    share, own = F.col("p_b") / F.col("p_l"), F.col("u_b") / F.col("u_l")
    spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) / F.col("u_l"))
    alike = (F.col("u_l") > 0) & (F.col("p_k") > 1) & (F.abs(own - share) <= ALIKE * spread)
    both = both.withColumn("u_alike", F.coalesce(alike, F.lit(False)))
    merged = both.filter("u_alike").groupBy("u_host", "u_kin").agg(
        F.sum("u_l").alias("m_l"), F.sum("u_b").alias("m_b"), F.array_join(F.array_sort(F.collect_set("u_first")), "|").alias("m_first")
    )
    done = both.join(merged, ["u_host", "u_kin"], "left").select(
        "u_host",
        "u_name",
        F.when(F.col("u_alike"), F.array_join(F.concat(F.slice("u_tpl", 1, 1), F.array(F.concat(F.lit("{"), F.col("m_first"), F.lit("}"))), F.slice("u_tpl", 3, LEVELS + 1)), "/"))
        .otherwise(F.col("u_name")).alias("template"),
        F.when(F.col("u_alike"), F.col("m_l")).otherwise(F.col("u_l")).alias("labelled"),
        F.when(F.col("u_alike"), F.col("m_b")).otherwise(F.col("u_b")).alias("blocked"),
    )
    out = named.join(done, ["u_host", "u_name"])
    purity = (F.col("blocked") + SMOOTH) / (F.col("labelled") + 2 * SMOOTH)
    return out.select("u_host", "u_branch", "template", "labelled", "blocked", purity.alias("purity"))


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, template, purity."""
    seen = pages.select(F.col(page_id).alias("u_id"), url_host(F.col(url)).alias("u_host"), url_path(F.col(url)).alias("u_path"))
    seen = seen.withColumn("u_rule", matching_rule(F.col("u_host"), F.col("u_path"), rules)).withColumn("u_branch", branch_of(F.col("u_path")))
    label = F.when(F.col("u_rule.verdict") == "block", 1).when(F.col("u_rule.verdict") == "allow", 0)
    tree = template_purity(seen.select("u_host", "u_branch", label.alias("u_label")))
    # A hot host's branches are many, and a hot branch's urls meet one narrow row: the engine may split such partitions.
    found = seen.join(tree, ["u_host", "u_branch"], "left")
    own = F.when(F.col("purity") >= PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        "u_id",
        F.col("u_host").alias("host"),
        F.col("u_path").alias("path"),
        F.col("u_rule.rule").alias("rule"),
        F.coalesce(F.col("u_rule.verdict"), own).alias("verdict"),
        "template",
        "purity",
    )


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge_urls(open_table(spark, sf_dir, "pages", "page_id", "url")).withColumnRenamed("u_id", "page_id")
