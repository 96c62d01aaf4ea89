"""URL filter by a path-template tree, in DataFrame operations only.

A url is judged by the longest fixed rule that fits its host and path, else
by its path template:

* per host, path segments become tree levels; digits in a segment become
  ``#``, and a segment seen rarely under a parent with many children is a
  wildcard ``*``;
* sibling branches whose labelled rate of bad pages does not differ from
  their parent's beyond chance are merged into the wildcard branch;
* levels follow one another while a node still has paths of further segments;
  from level ``DEPTH`` on, segments that all paths of a node share are passed
  at once, and rates change only where a node branches; a node without a
  labelled page keeps its rate all the way down, so it ends there, its further
  segments written ``**``: levels follow the labelled paths only;
* each template's bad rate is smoothed towards its parent's, up to the host
  and the whole table; a template whose purity (1 - rate) is too low is
  rejected.

Statistics cover all pages. They are grouped aggregates over distinct
templates with map-side partial sums, so a host with a third of all pages
costs one partial row per task and template.

Defined results: a null url or one without ``://`` has an empty host and
path and belongs to the template of those; repeated rows are judged alike;
without labels every template keeps the prior and is allowed; an empty table
gives an empty result; paths of any length are followed as far as labels go;
further columns are not read.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import column
from sigflow.session import ensure_checkpoint_dir

DEPTH = 3  # levels that every path has, empty ones after its end; longer paths go on below them
MANY_CHILDREN = 8  # a parent with so many distinct children ...
RARE = 2  # ... has a variable segment where a child is seen at most so often
Z = 1.96  # a branch stays apart if its bad rate lies outside this many standard errors
STRENGTH = 5.0  # pages the parent's rate weighs in smoothing
PRIOR = 0.1  # bad rate assumed, with the same weight, for the whole table
PURITY = 0.5  # templates below are rejected


class Rule(NamedTuple):
    verdict: str
    pattern: str  # host, then the path prefix from the first slash


RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits; null if none does."""
    pattern = verdict = F.when(F.lit(False), F.lit(""))
    for r in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern)):
        cut = r.pattern.index("/")
        h, p = r.pattern[:cut], r.pattern[cut:]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        pattern, verdict = pattern.when(fits, r.pattern), verdict.when(fits, r.verdict)
    return pattern, verdict


def _level(nodes: DataFrame, g: str, deep: bool = False) -> DataFrame:
    """One level down the tree: wildcards, merged branches, smoothed rates.

    ``deep``: a branch that is all of its parent keeps the rate as it is, so depth alone adds no weight.
    """
    parent = nodes.groupBy("node").agg(
        F.count_distinct(g).alias("p_kids"), F.sum("lab").alias("p_lab"), F.sum("bad").alias("p_bad")
    )
    child = nodes.groupBy("node", g).agg(
        F.sum("n").alias("c_n"), F.sum("lab").alias("c_lab"), F.sum("bad").alias("c_bad"), F.first("rate").alias("p_rate")
    ).join(parent, "node")
    variable = (F.col("p_kids") >= MANY_CHILDREN) & (F.col("c_n") <= RARE)
    # |bad_c/lab_c - p| <= Z * sqrt(p (1 - p) / lab_c), without division
    off = F.col("c_bad") * F.col("p_lab") - F.col("p_bad") * F.col("c_lab")
    spread = F.lit(Z * Z) * F.col("p_bad") * (F.col("p_lab") - F.col("p_bad")) * F.col("c_lab")
    similar = off.cast("double") * off <= spread
    child = child.withColumn("t", F.when((F.col(g) != "") & (variable | similar), "*").otherwise(F.col(g)))
    rate = (F.sum("c_bad") + F.lit(STRENGTH) * F.first("p_rate")) / (F.sum("c_lab") + F.lit(STRENGTH))
    if deep:
        rate = F.when(F.count(F.lit(1)) == F.first("p_kids"), F.first("p_rate")).otherwise(rate)
    merged = child.groupBy("node", "t").agg(rate.alias("new_rate"))
    named = child.select("node", g, "t").join(merged, ["node", "t"])
    joined = nodes.join(named, ["node", g])
    down = joined.withColumn("node", F.concat_ws("/", "node", "t")).withColumn("rate", F.col("new_rate"))
    return down.drop("t", "new_rate").checkpoint()  # read several times by the next level


def _deeper(nodes: DataFrame) -> DataFrame:
    """The levels below ``DEPTH``, until the paths of every node have ended."""
    ended, nodes = [], nodes.withColumn("left", F.col("rest"))
    names = nodes.columns
    while True:
        span = nodes.groupBy("node").agg(F.min("left").alias("lo"), F.max("left").alias("hi"), F.sum("lab").alias("labelled"))
        # what the first and the last path have in common, all between them have
        differ = F.array_position(F.zip_with("lo", "hi", lambda x, y: x.eqNullSafe(y)), False)
        common = F.when(differ == 0, F.size("lo")).otherwise((differ - 1).cast("int"))
        settled = (differ != 0) & (F.col("labelled") == 0)
        end = (differ == 0) | (F.col("labelled") == 0)
        passed = nodes.join(span.select("node", common.alias("common"), settled.alias("settled"), end.alias("end")), "node")
        passed = passed.withColumns({
            "node": F.concat("node", F.repeat(F.lit("/*"), F.col("common")), F.when(F.col("settled"), "/**").otherwise("")),
            "left": F.slice("left", F.col("common") + 1, F.size("left")),
        }).checkpoint()
        ended.append(passed.filter("end").select(*names))
        going = passed.filter("not end").select(*names, F.coalesce(F.get("left", F.lit(0)), F.lit("")).alias("g"))
        if going.isEmpty():
            break
        nodes = _level(going, "g", deep=True).withColumn("left", F.slice("left", 2, F.size("left"))).select(*names)
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def url_templates(judged: DataFrame) -> DataFrame:
    """(host, g1..gDEPTH, rest, template, purity) of every distinct path shape.

    ``judged`` has host, g1.., rest (the segments after them), lab (1 for labelled pages) and bad (1 for bad ones).
    """
    gs = [f"g{k + 1}" for k in range(DEPTH)]
    shapes = judged.groupBy("host", *gs, "rest").agg(
        F.count(F.lit(1)).alias("n"), F.sum("lab").alias("lab"), F.sum("bad").alias("bad")
    ).checkpoint()
    both = shapes.agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad")).first()
    everywhere = ((both.bad or 0) + STRENGTH * PRIOR) / ((both.lab or 0) + STRENGTH)
    hosts = shapes.groupBy("host").agg(
        ((F.sum("bad") + F.lit(STRENGTH * everywhere)) / (F.sum("lab") + F.lit(STRENGTH))).alias("rate")
    )
    nodes = shapes.join(hosts, "host").withColumn("node", F.col("host")).checkpoint()
    for g in gs:
        nodes = _level(nodes, g)
    nodes = _deeper(nodes)
    return nodes.select("host", *gs, "rest", F.col("node").alias("template"), (F.lit(1.0) - F.col("rate")).alias("purity"))


def judge_urls(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
    purity: float = PURITY,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every page.

    ``labels``: columns id and bad (0/1, null: not labelled); several rows of
    an id count as bad if one is.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    slim = pages.select(column(pages, id_col).alias("page_id"), column(pages, url_col).cast("string").alias("url"))
    cut = slim.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    segments = F.filter(F.split(F.regexp_replace("path", r"[0-9]+", "#"), "/"), lambda s: s != "")
    cut = cut.withColumns({"rule": rule, "rule_verdict": verdict, "segments": segments})
    for k in range(DEPTH):
        cut = cut.withColumn(f"g{k + 1}", F.coalesce(F.get("segments", F.lit(k)), F.lit("")))
    cut = cut.withColumn("rest", F.slice("segments", DEPTH + 1, F.greatest(F.size("segments"), F.lit(1))))
    known = labels.groupBy("id").agg(F.max("bad").alias("bad")).withColumn("lab", F.when(F.col("bad").isNotNull(), 1).otherwise(0))
    cut = cut.join(known, cut["page_id"] == known["id"], "left").drop("id", "segments")
    cut = cut.withColumns({"lab": F.coalesce("lab", F.lit(0)), "bad": F.coalesce("bad", F.lit(0))})
    gs = [f"g{k + 1}" for k in range(DEPTH)]
    found = cut.join(url_templates(cut), ["host", *gs, "rest"])
    return found.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("purity") < purity, "block").otherwise("allow")).alias("verdict"),
        "template", "purity",
    )
