"""URL filter by a path-template tree learnt from labelled URLs.

For each host the paths form a tree of segments, built level by level from counts that Spark aggregates:

1. variable segments: a segment of digits, hex, a date or a file name of digits becomes its class (`<num>` ...);
   then, under one parent, if the rare segments (each at most a small share of the parent's URLs) are many, these
   become `*`; a frequent segment stays a branch of its own, however many rare ones are beside it;
2. similar branches: a branch whose share of labelled block URLs and share of URLs ending there do not differ
   significantly (two-proportion z-tests) from its siblings together is merged into `*` as well;
3. a template is rejected when its labelled URLs are mostly to block: (blocked + s * base) / (labelled + s) with the
   base rate among all labelled URLs and strength s. At least the share `known` of a template's URLs must be labelled: a
   few blocked ones do not speak for the many unlabelled ones that share a wildcard with them.

The first `depth` levels are always built; below them the tree goes on where a node has blocked URLs and more than one
path, so a blocked branch is told from a clean one however deep they part. What is not followed is one tail. Counts move through shuffles after partial aggregation by (host, prefix,
segment), so a host with a third of all pages is a few counts per task; the tree of templates is joined, never
collected. Rules given by hand win over the tree.

Defined results: a null URL or one without `://` has an empty host and path, its own template; a rule's path must be a
prefix of the URL's path as it is; no labelled URL means nothing is rejected; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.store import stored

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    depth: int = 4
    many: int = 20  # rare segments under one parent
    rare: float = 0.1  # of the parent's URLs, at most, in each of them
    z: float = 1.96
    strength: float = 2.0
    reject: float = 0.7
    known: float = 0.5


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. The rules are a hand-written list and become one expression."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the last match wins: the longest
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _class(segment: Column) -> Column:
    return (
        F.when(segment.rlike(r"^[0-9]+$"), F.lit("<num>"))
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z]{1,5}$"), F.lit("<num-file>"))
        .when(segment.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), F.lit("<date>"))
        .when(segment.rlike(r"^[0-9a-fA-F]{8,}$|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), F.lit("<hex>"))
        .otherwise(segment)
    )


def segments_of(path: Column) -> Column:
    """The classes of a path's segments."""
    return F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), _class)


def _z(k: Column, n: Column, others_k: Column, others_n: Column) -> Column:
    """Two-proportion z of k of n against the others; null if there is nothing to compare."""
    one = F.lit(1.0)
    pooled = F.try_divide(k + others_k, n + others_n)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(one, n) + F.try_divide(one, others_n)))
    apart = F.abs(F.try_divide(k, n) - F.try_divide(others_k, others_n))
    return F.when(spread > 0, F.try_divide(apart, spread)).when(spread == 0, F.lit(0.0))


def templates(paths: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`paths` (host, segments, blocked, labelled, urls): each with its template.

    Works on distinct (host, segments), level by level; each level's result is stored, as the next reads it twice.
    """
    out = stored(paths.withColumn("template", F.lit("")), "url-paths")
    closed, level = None, 0
    while True:
        if level >= settings.depth:
            more = F.size("segments") > level
            nodes = out.filter(more).groupBy("host", "template").agg(F.sum("blocked").alias("bad"), F.count("*").alias("n"))
            on = nodes.filter("bad > 0 AND n > 1").select("host", "template", F.lit(True).alias("on"))
            out = stored(out.join(on, ["host", "template"], "left"), "url-open")
            tail = F.when(more, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
            ended = out.filter("on IS NULL").drop("on").withColumn("template", tail)
            closed = ended if closed is None else closed.unionByName(ended)
            out = out.filter("on").drop("on")
            if out.isEmpty():
                return closed
        segment = F.try_element_at(F.col("segments"), F.lit(level + 1))
        out = out.withColumn("segment", segment)
        ends = F.when(F.size("segments") == level + 1, F.col("urls")).otherwise(F.lit(0))
        children = (
            out.filter(F.col("segment").isNotNull())
            .groupBy("host", "template", "segment")
            .agg(*(F.sum(x).alias(x) for x in ("urls", "blocked", "labelled")), F.sum(ends).alias("ending"))
        )
        totals = children.groupBy("host", "template").agg(
            F.sum("urls").alias("all_urls"),
            F.sum("blocked").alias("all_blocked"),
            F.sum("labelled").alias("all_labelled"),
            F.sum("ending").alias("all_ending"),
        )
        rare = F.col("urls") <= settings.rare * F.col("all_urls")
        judged = children.join(totals, ["host", "template"]).withColumn("rare", rare)
        kinds = judged.groupBy("host", "template").agg(F.count_if("rare").alias("kinds"))
        judged = judged.join(kinds, ["host", "template"])
        other = {x: F.col(f"all_{x}") - F.col(x) for x in ("urls", "blocked", "labelled", "ending")}
        variable = F.col("rare") & (F.col("kinds") >= settings.many)
        evidence = (F.col("labelled") > 0) & (other["labelled"] > 0)
        similar = evidence & F.coalesce(
            (_z(F.col("blocked"), F.col("labelled"), other["blocked"], other["labelled"]) < settings.z)
            & (_z(F.col("ending"), F.col("urls"), other["ending"], other["urls"]) < settings.z),
            F.lit(False),
        )
        named = judged.select(
            "host",
            "template",
            "segment",
            F.when(variable | similar, F.lit("*")).otherwise(F.col("segment")).alias("name"),
        )
        placed = (
            out.join(named, ["host", "template", "segment"], "left")
            .withColumn(
                "template",
                F.when(F.col("name").isNotNull(), F.concat("template", F.lit("/"), "name")).otherwise(F.col("template")),
            )
            .drop("name", "segment")
        )
        out = stored(placed, "url-level")
        level += 1


def rejected_templates(paths: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`paths` as in `templates`, returned per (host, segments) with template, purity and whether it is rejected."""
    placed = templates(paths, settings)
    per = placed.groupBy("host", "template").agg(
        F.sum("blocked").alias("template_blocked"),
        F.sum("labelled").alias("template_labelled"),
        F.sum("urls").alias("template_urls"),
    )
    sums = placed.agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")).first()  # one row
    base = sums["blocked"] / sums["labelled"] if sums["labelled"] else 0.0
    purity = (F.col("template_blocked") + settings.strength * base) / (F.col("template_labelled") + settings.strength)
    per = per.withColumn("purity", purity)
    labelled = (F.col("template_labelled") > 0) & (F.col("template_labelled") >= settings.known * F.col("template_urls"))
    rejected = labelled & (F.col("purity") >= settings.reject)
    per = per.select("host", "template", "purity", rejected.alias("rejected"))
    return placed.select("host", "segments", "template").join(per, ["host", "template"])


def judge(pages: DataFrame, rules: dict[str, str], settings: Settings = Settings()) -> DataFrame:
    """Every page's host, path, rule and verdict; URLs that a rule decides are the labels of the tree."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("segments", segments_of(F.col("path")))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    rows = rows.withColumn("by_rule", by_rule)
    paths = rows.groupBy("host", "segments").agg(
        F.count("*").alias("urls"),
        F.count("by_rule").alias("labelled"),
        F.count(F.when(F.col("by_rule") == BLOCK, True)).alias("blocked"),
    )
    learnt = rejected_templates(paths, settings)
    verdict = F.coalesce("by_rule", F.when(F.col("rejected"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return rows.join(learnt, ["host", "segments"], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )
