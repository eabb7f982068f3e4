"""Operator 6: url filters by rules and a path-template tree, in DataFrame functions only.

A rule (host and path prefix) decides the urls of its host and of all subdomains whose path begins with its path; the longest
rule wins.  Urls without a rule are judged by a tree of path templates per host, learnt from all urls that have one:

1. digits in a path become ``#`` and equal paths of a host become one counted row, so a host with a third of all
   urls is few rows from here on;
2. level by level, a segment turns into the wildcard ``*`` if its parent has ``MIN_CHILDREN`` children or more and
   the segment holds less than ``MIN_SHARE`` of the parent's urls, however deep the paths are;
3. sibling templates whose share of blocked urls does not differ from their parent's (|z| <= ``Z``), or that have none
   labelled, are merged;
4. a template is rejected if its blocked share, smoothed by ``ALPHA`` urls at the share of the same template on all
   hosts (itself smoothed by the share of all labelled urls), is above one half.

Defined results: a null url or one without ``://`` has empty host and path and no rule, and is judged as the root template
of the empty host; without any labelled url everything else is allowed; rows repeat as they come.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
MIN_CHILDREN, MIN_SHARE = 8, 0.05
Z = 1.96
ALPHA = 5.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first, so it wraps the others
        at = text.index("/")
        fits = ((host == text[:at]) | F.endswith(host, F.lit("." + text[:at]))) & F.startswith(path, F.lit(text[at:]))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, masked, n, allowed, blocked) plus the template (array of segments) of each.  Paths go on to the
    next level only while ``MIN_CHILDREN`` or more of them share their template so far: below that no segment
    can become a wildcard any more and the rest of the path stays as it is."""
    keep = ["host", "masked", "n", "allowed", "blocked"]
    cur = materialise(paths.withColumn("segments", F.filter(F.split("masked", "/"), lambda x: x != ""))
                      .withColumn("template", F.array().cast("array<string>")), "url-paths")
    depth = cur.agg(F.max(F.size("segments"))).first()[0] or 0
    ended = [cur.where(F.size("segments") == 0).select(*keep, "template")]
    for level in range(1, depth + 1):
        here = cur.where(F.size("segments") >= level).withColumn("segment", F.element_at("segments", level))
        child = here.groupBy("host", "template", "segment").agg(F.sum("n").alias("own"), F.count(F.lit(1)).alias("paths"))
        parent = child.groupBy("host", "template").agg(
            F.sum("own").alias("all"), F.count(F.lit(1)).alias("children"), F.sum("paths").alias("paths"))
        varies = (F.col("children") >= MIN_CHILDREN) & (F.col("own") < MIN_SHARE * F.col("all"))
        step = child.drop("paths").join(parent, ["host", "template"]).select(
            "host", "template", "segment", F.when(varies, F.lit("*")).otherwise(F.col("segment")).alias("as"),
            (F.col("paths") >= MIN_CHILDREN).alias("crowded"))
        goes_on = F.col("crowded") & (F.size("segments") > level)
        rest = F.when(F.col("crowded"), F.array("as")).otherwise(F.slice("segments", F.lit(level), F.size("segments")))
        cur = materialise(here.join(step, ["host", "template", "segment"])
                          .select(*keep, "segments", F.concat("template", rest).alias("template"), goes_on.alias("goes_on")),
                          f"url-level{level}")
        ended.append(cur.where("not goes_on").select(*keep, "template"))
        cur = cur.where("goes_on").drop("goes_on")
        if cur.isEmpty():
            break
    return reduce(DataFrame.unionByName, ended)


def judge_templates(found: DataFrame) -> DataFrame:
    """host, template -> purity: the smoothed blocked share of the template's group."""
    nodes = found.groupBy("host", "template").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    nodes = materialise(nodes.withColumn("parent", F.when(F.size("template") > 0, F.slice("template", F.lit(1), F.size("template") - 1))), "url-nodes")
    pooled = nodes.groupBy("host", "parent").agg(F.sum("allowed").alias("p_allowed"), F.sum("blocked").alias("p_blocked"))
    labelled = F.col("allowed") + F.col("blocked")
    rate = F.try_divide("blocked", labelled)
    whole = F.try_divide("p_blocked", F.col("p_allowed") + F.col("p_blocked"))
    similar = (labelled == 0) | (F.abs(rate - whole) <= Z * F.sqrt(whole * (1 - whole) / F.greatest(labelled, F.lit(1))) + 1e-12)
    same_parent = (nodes["host"] == pooled["host"]) & nodes["parent"].eqNullSafe(pooled["parent"])
    nodes = nodes.join(pooled.withColumnRenamed("host", "p_host").withColumnRenamed("parent", "p_parent"),
                       (F.col("host") == F.col("p_host")) & F.col("parent").eqNullSafe(F.col("p_parent"))).drop("p_host", "p_parent")
    # similar siblings form one group, named by the parent; the others stand alone
    nodes = nodes.withColumn("group", F.when(similar, F.concat(F.coalesce("parent", F.array(F.lit("/"))), F.array(F.lit("**")))).otherwise(F.col("template")))
    groups = nodes.groupBy("host", "group").agg(F.sum("allowed").alias("g_allowed"), F.sum("blocked").alias("g_blocked"))
    anywhere = nodes.groupBy("template").agg(F.sum("allowed").alias("t_allowed"), F.sum("blocked").alias("t_blocked"))
    total = nodes.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    all_labelled = (total.a or 0) + (total.b or 0)
    overall = (total.b or 0) / all_labelled if all_labelled else 0.0
    prior = (F.col("t_blocked") + ALPHA * overall) / (F.col("t_allowed") + F.col("t_blocked") + ALPHA)
    purity = (F.col("g_blocked") + ALPHA * prior) / (F.col("g_allowed") + F.col("g_blocked") + ALPHA)
    return nodes.join(groups, ["host", "group"]).join(anywhere, "template").select("host", "template", purity.alias("purity"))


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template and purity of its template."""
    host, path = host_and_path(F.col(url))
    split = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.withColumn("rule", rule).withColumn("by_rule", by_rule).withColumn("masked", F.regexp_replace("path", "[0-9]+", "#"))
    counted = ruled.groupBy("host", "masked").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("by_rule") == "allow").alias("allowed"),
        F.count_if(F.col("by_rule") == "block").alias("blocked"))
    found = materialise(templates(counted), "url-templates")
    verdicts = found.join(judge_templates(found), ["host", "template"]).select(
        "host", "masked", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity")
    return ruled.join(verdicts, ["host", "masked"]).select(
        F.col("page_id").alias(page_id), "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("purity") > 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template", "purity")
