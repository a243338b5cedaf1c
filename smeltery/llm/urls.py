"""URL filters: host and path rules, and a path-template tree for what no rule decides.

Per host, paths become templates: runs of digits and long segments are wildcards from the
start; then, level by level from the root, a node whose children are many and thin gets one
wildcard child, and labelled branches whose share of blocked pages does not differ from the
node's get one common branch. The pages that a rule decides are the labels. A template is
blocked when its smoothed share of blocked labels reaches ``PURE``.

The tree is built on counts per host and raw template, never on pages. Each level is stored, and
the next works on what has further segments and is not alone at its node: the steps of a single
raw template depend on its own counts only and are taken at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import ascii_lower, stored

#: Action, host and path of each rule.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Longest literal segment; children of a node beyond which they are one wildcard when a child has
#: fewer than ``THIN`` pages on average.
LITERAL, KIDS, THIN = 32, 32, 4
#: Labels a branch needs to be merged, squared deviations allowed, smallest variance assumed.
LABELS, DEVIATIONS, VARIANCE = 5, 4.0, 0.01
#: Blocked share assumed before any label, its weight in labels, and the share that blocks.
PRIOR, PRIOR_WEIGHT, PURE = 0.1, 4.0, 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased (A-Z) host after the first ``://`` and the path after it; empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its action; NULL when none fits."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, action = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, kind).otherwise(action)
    return name, action


def raw_segments(path: Column) -> Column:
    """All segments, digits and long segments already wildcards."""
    return F.transform(
        F.filter(F.split(path, "/", -1), lambda x: x != ""),
        lambda x: F.when(F.length(x) > LITERAL, "*").otherwise(F.regexp_replace(x, "[0-9]+", "{n}")),
    )


def templates(labelled: DataFrame) -> DataFrame:
    """``host, segments, template, pages, labels, blocked`` from pages with ``host, segments, action``."""
    measures = ["pages", "labels", "blocked"]
    tree = labelled.groupBy("host", "segments").agg(
        F.count("*").alias("pages"), F.count("action").alias("labels"), F.count_if(F.col("action") == "block").alias("blocked")
    ).withColumn("template", F.lit(""))
    columns, parts, level = tree.columns, [], 0
    tree = stored(tree, "url-level")
    while not tree.isEmpty():
        tree = tree.withColumn("own", F.coalesce(F.get("segments", F.lit(level)), F.lit("")))
        sums = [F.sum(c).alias(c) for c in (*measures, "raw")]
        children = tree.withColumn("raw", F.lit(1)).groupBy("host", "template", "own").agg(*sums)
        nodes = children.groupBy("host", "template").agg(F.count("*").alias("kids"), *sums)
        nodes = nodes.select("host", "template", "kids", *[F.col(c).alias(f"all_{c}") for c in (*measures, "raw")])
        share, usual = F.try_divide("blocked", "labels"), F.try_divide("all_blocked", "all_labels")
        alike = (F.col("labels") >= LABELS) & (
            (share - usual) * (share - usual) * F.col("labels") <= DEVIATIONS * F.greatest(usual * (1 - usual), F.lit(VARIANCE))
        )
        many = (F.col("kids") > KIDS) & (F.col("all_pages") < THIN * F.col("kids"))
        step = F.when(F.col("own") == "", "").when(many, "/*").when(alike, "/+").otherwise(F.concat(F.lit("/"), "own"))
        named = children.join(nodes, ["host", "template"]).select(
            "host", "template", "own", step.alias("step"), (F.col("all_raw") == 1).alias("alone")
        )
        alone, rest = F.col("alone"), F.slice("segments", level + 1, F.greatest(F.size("segments"), F.lit(1)))
        of_one = F.transform(rest, lambda x: F.when(F.col("labels") >= LABELS, "/+").otherwise(F.concat(F.lit("/"), x)))
        further = F.when(alone, F.array_join(of_one, "")).otherwise(F.col("step"))
        done = alone | (F.col("own") == "")
        walked = tree.join(named, ["host", "template", "own"]).select(
            "host", "segments", *measures, F.concat("template", further).alias("template"), done.alias("done")
        )
        walked = stored(walked, "url-level")
        parts.append(walked.where("done").select(*columns))
        tree = walked.where(~F.col("done")).select(*columns)
        level += 1
    return reduce(DataFrame.union, parts) if parts else tree


def judge(
    pages: DataFrame, url_column: str = "url", rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """All rows and columns of ``pages`` with ``host, path, rule, template`` and ``verdict``.

    NULL urls and urls without ``://`` have empty host and path and are judged like any other;
    paths are read whole, however many segments they have. The verdict is the longest fitting
    rule's, else ``block`` for pure enough templates and ``allow`` for all others; a template
    without labels is allowed. Repeated rows stay and count each time; other columns may have any
    name, and those with the names of the result are replaced; an empty table gives an empty result.
    """
    result = ("host", "path", "rule", "template", "verdict")
    kept = [c for c in pages.columns if c not in result]
    host, path = host_and_path(F.col(f"`{url_column}`").cast("string"))
    parsed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), host.alias("host"), path.alias("path"))
    name, action = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("*", name.alias("rule"), action.alias("action"), raw_segments(F.col("path")).alias("segments"))
    tree = templates(parsed.select("host", "segments", "action"))
    purity = (F.sum("blocked") + PRIOR * PRIOR_WEIGHT) / (F.sum("labels") + PRIOR_WEIGHT)
    judged = tree.groupBy("host", "template").agg(F.when(purity >= PURE, "block").otherwise("allow").alias("judged"))
    known = tree.select("host", "segments", "template").join(judged, ["host", "template"])
    return parsed.join(known, ["host", "segments"]).select(
        *[F.col(f"row.`{c}`") for c in kept], *result[:-1], F.coalesce("action", "judged").alias("verdict")
    )
