"""URL filters: fixed rules, and templates of a path tree rejected by smoothed labelled purity.

Only DataFrame functions are used.

1. A URL is cut into host and path; the longest rule that fits gives its
   verdict, and thereby a label for learning.
2. Distinct (host, path) rows are counted with their labels, and each path
   becomes a way down its host's tree: a node is (host, depth, shapes of the
   segments above, shape of the segment), where a shape replaces words by
   ``a`` and anything with a digit by ``#``.
3. A child segment keeps its literal only if it is frequent in its node (at
   least ``min_count`` rows and ``min_share`` of the node's) and its labelled
   branch differs significantly from the whole node's (chi-square of the
   blocked share, one degree of freedom); all other branches are variable or
   statistically similar and merge into the wildcard ``*``.
4. A template (host and generalised path) is rejected if at least
   ``min_labelled`` rows and ``min_labelled_share`` of its rows are labelled
   and its blocked share, smoothed towards its host's and that towards the
   whole table's, reaches ``purity``.  The share is the evidence that the
   branches merged into it are alike: where most rows say nothing (4 blocked
   pages beside 100 unlabelled ones), none of them is rejected for the few.

Everything is counted over all rows; hot hosts and paths are pre-aggregated
before each exchange, and no group is gathered (a path's own segments apart).
The shapes above a node are known by a 128-bit hash, so a node's key has one
size whatever the length of the path, and no two nodes share counts.

Cases: a null URL or one without ``://`` has an empty host and path; null
page ids and repeated rows are judged each; without labels nothing is rejected
beyond the rules; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The contract's rules (host and path prefix, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    min_count: int = 5
    min_share: float = 0.01
    chi_square: float = 3.84
    host_weight: float = 2.0
    template_weight: float = 4.0
    min_labelled: int = 3
    min_labelled_share: float = 0.1
    purity: float = 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))

    return F.translate(part(1), UPPER, LOWER), part(2)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls.  The rules are a short fixed list: a chain of conditions."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: len(x[0])):  # later conditions win
        own, _, rest = r.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(segment, "[0-9A-Za-z]*[0-9][0-9A-Za-z]*", "#"), "[A-Za-z]+", "a")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and rule_verdict of every page."""
    host, path = host_and_path(F.col("url").cast("string"))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return parts.withColumns({"rule": rule, "rule_verdict": verdict})


def path_counts(pages: DataFrame) -> DataFrame:
    """Distinct (host, path) with the numbers of rows, of labelled and of blocked rows."""
    labelled = F.col("rule_verdict").isNotNull().cast("long")
    return pages.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(labelled).alias("labelled"),
                                             F.sum(F.coalesce((F.col("rule_verdict") == "block").cast("long"), F.lit(0))).alias("blocked"))


def segments(paths: DataFrame) -> DataFrame:
    """One row per segment of a path: its node (host, depth, above, shape) and literal."""
    split = F.split(F.regexp_replace("path", "^/", ""), "/", -1)
    above = F.md5(F.array_join(F.slice("shapes", 1, F.col("depth")), "/").cast("binary"))
    return paths.withColumn("parts", split).withColumn("shapes", F.transform("parts", shape)).select(
        "host", "path", "n", "labelled", "blocked", "shapes", F.posexplode("parts").alias("depth", "literal")).select(
        "host", "path", "n", "labelled", "blocked", "depth", "literal", above.alias("above"), shape(F.col("literal")).alias("shape"))


NODE = ["host", "depth", "above", "shape"]


def kept_literals(segs: DataFrame, s: Settings) -> DataFrame:
    """The branches that stay apart from their node's wildcard."""
    child = segs.groupBy(*NODE, "literal").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    node = child.groupBy(*NODE).agg(F.sum("n").alias("node_n"), F.sum("labelled").alias("node_labelled"), F.sum("blocked").alias("node_blocked"))
    rate = (F.col("node_blocked") + 1) / (F.col("node_labelled") + 2)
    off = F.col("blocked") - F.col("labelled") * rate
    differs = off * off > F.lit(s.chi_square) * F.col("labelled") * rate * (1 - rate)
    frequent = (F.col("n") >= s.min_count) & (F.col("n") >= F.lit(s.min_share) * F.col("node_n"))
    return child.filter(F.col("n") >= s.min_count).join(node, NODE).filter(frequent & (F.col("labelled") > 0) & differs).select(*NODE, "literal")


def templates(paths: DataFrame, s: Settings) -> DataFrame:
    """host, path, n, labelled, blocked and the template of each distinct path."""
    segs = segments(paths)
    kept = kept_literals(segs, s).withColumn("keep", F.lit(True))
    marked = segs.join(kept, [*NODE, "literal"], "left")
    part = F.struct("depth", F.when(F.col("keep"), F.col("literal")).otherwise("*").alias("part"))
    template = F.concat(F.lit("/"), F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["part"]), "/"))
    return marked.groupBy("host", "path").agg(F.first("n").alias("n"), F.first("labelled").alias("labelled"),
                                              F.first("blocked").alias("blocked"), template.alias("template"))


def rejected(paths: DataFrame, ways: DataFrame, s: Settings) -> DataFrame:
    """host and template of the rejected templates."""
    total = paths.agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b")).first()  # one row
    base = ((total.b or 0) + 1) / ((total.l or 0) + 2)
    by_template = ways.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"),
                                                       F.sum("blocked").alias("blocked"))
    hosts = paths.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("blocked").alias("host_blocked"))
    prior = (F.col("host_blocked") + F.lit(s.host_weight) * F.lit(base)) / (F.col("host_labelled") + F.lit(s.host_weight))
    share = (F.col("blocked") + F.lit(s.template_weight) * prior) / (F.col("labelled") + F.lit(s.template_weight))
    evident = (F.col("labelled") >= s.min_labelled) & (F.col("labelled") >= F.lit(s.min_labelled_share) * F.col("n"))
    return by_template.filter(evident).join(hosts, "host").filter(share >= s.purity).select(
        "host", "template", F.lit(True).alias("bad"))


def verdicts(pages: DataFrame, rules=RULES, settings: Settings = Settings()) -> DataFrame:
    """page_id, host, path, rule, verdict and template of every page."""
    from clinlake.llm.common import cut

    rows = judged(pages, rules)
    paths = cut(path_counts(rows))
    ways = cut(templates(paths, settings))
    bad = rejected(paths, ways, settings)
    known = ways.join(bad, ["host", "template"], "left").select("host", "path", "template", "bad")
    return rows.join(known, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"), "template")
