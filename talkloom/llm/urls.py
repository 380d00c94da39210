"""URL filters: rules by host and path, and a path-template tree per host for what no rule fits. Native: SQL functions only.

A rule is a host and a path, like `example.com/en/`. It fits its host and all subdomains if the url's path starts with its path; the longest
rule that fits decides. What the rules decide labels the pages (or a column of labels does), and the method judges all others:

* The paths of a host form a tree of DEPTH levels of segments; what is deeper is one tail. At each node, top down, a segment that holds less than
  LEAST_SHARE of the node's pages, or fewer than LEAST_PAGES, is variable: all of these become one wildcard. So a node has a bounded number of constant branches.
* Statistically similar constant branches of a node are merged: they have the same rounded mean number of segments below, and, in order of their shares
  of blocked pages, neighbours are merged whose shares do not differ by more than Z standard errors. Branches without labels are merged among themselves only.
* A path's way through the tree is its template. A template is rejected if its labelled purity, smoothed by one page of either kind, reaches
  PURITY; so a template needs several labelled pages, nearly all blocked, and one without labels is allowed.

Distinct paths are counted before anything is shuffled further. Every level sends up counts per branch, combined before the shuffle, and takes back
the constant branches as a small table, broadcast only up to a checked size, so a host that holds a third of all pages is no single task.

Null urls and urls without "://" have the empty host and path, fit no rule, and share the template of the empty path. Equal urls get equal verdicts, repeated rows come out
as often as they go in, an empty table gives no rows. Queries and fragments are no part of a path, empty segments no part of a template. Columns other than page_id and url are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.tables import few, written

DEPTH = 4
LEAST_PAGES, LEAST_SHARE = 3, 0.05
Z = 1.96
PURITY = 0.8
WILDCARD, TAIL = "*", "**"

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _CAPITALS, _CAPITALS.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def decided(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one. rules: (verdict, rule)."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        of, _, start = rule.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit(f".{of}"))) & F.startswith(path, F.lit(f"/{start}"))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _branches(paths: DataFrame, level: int) -> DataFrame:
    """host, way, segment, step: the constant branches of every node of a level and what they are called in templates."""
    node = ["host", "way"]
    below = F.least(F.size("segments"), F.lit(DEPTH)) - (level + 1)
    here = paths.filter(F.size("segments") > level).withColumn("segment", F.col("segments")[level])
    counts = here.groupBy(*node, "segment").agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("bad").alias("bad"), F.sum(below * F.col("n")).alias("below"))
    counts = written(counts)
    totals = counts.groupBy(*node).agg(F.sum("n").alias("total"))
    kept = counts.filter(F.col("n") >= LEAST_PAGES).join(totals, node).filter(F.col("n") >= LEAST_SHARE * F.col("total"))
    some = F.nullif("known", F.lit(0))
    labelled, share = some.isNotNull(), F.col("bad") / some
    alike = Window.partitionBy(*node, "labelled", "shape").orderBy("share", "segment")
    kept = kept.select(*node, "segment", "known", "bad", labelled.alias("labelled"), share.alias("share"), F.floor(F.col("below") / F.col("n") + 0.5).alias("shape"))
    kept = kept.withColumns({"known_0": F.lag("known").over(alike), "bad_0": F.lag("bad").over(alike), "share_0": F.lag("share").over(alike)})
    pooled = (F.col("bad") + F.col("bad_0")) / (some + F.col("known_0"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / some + 1 / F.nullif("known_0", F.lit(0))))
    differs = F.col("labelled") & (F.col("share") - F.col("share_0") > Z * error)
    kept = kept.withColumn("group", F.sum(F.coalesce(differs, F.lit(False)).cast("int")).over(alike))
    first = F.min("segment").over(Window.partitionBy(*node, "labelled", "shape", "group"))
    step = F.when(F.startswith(first, F.lit(WILDCARD)), F.concat(F.lit(WILDCARD), first)).otherwise(first)
    return kept.select(*node, "segment", F.when(step == TAIL, F.lit("***")).otherwise(step).alias("step"))


def templates(paths: DataFrame) -> DataFrame:
    """paths with `way`, their template. paths: host, path (distinct), n pages, `known` of them labelled, `bad` of these blocked."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    paths = paths.withColumns({"segments": segments, "way": F.lit("")})
    for level in range(DEPTH):
        found = few(written(_branches(paths, level)))
        at = F.when(F.size("segments") > level, F.col("segments")[level])
        paths = paths.withColumn("segment", at).join(found, ["host", "way", "segment"], "left")
        way = F.concat("way", F.lit("/"), F.coalesce("step", F.lit(WILDCARD)))
        paths = paths.withColumn("way", F.when(F.col("segment").isNull(), F.col("way")).otherwise(way)).drop("segment", "step")
    return paths.withColumn("way", F.when(F.size("segments") > DEPTH, F.concat("way", F.lit("/"), F.lit(TAIL))).otherwise(F.col("way"))).drop("segments")


def rejected(ways: DataFrame) -> DataFrame:
    """host, way of the templates whose smoothed labelled purity reaches PURITY."""
    sums = ways.groupBy("host", "way").agg(F.sum("known").alias("known"), F.sum("bad").alias("bad"))
    return sums.filter((F.col("bad") + 1) / (F.col("known") + 2) >= PURITY).select("host", "way")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], label: str | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every page. `label` names a column that is 1 for pages known to be bad, 0 for good, else null;
    without it the rules' verdicts are the labels."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), *([F.col(label).alias("label")] if label else []))
    rule, verdict = decided(rules, F.col("host"), F.col("path"))
    parsed = parsed.withColumns({"rule": rule, "ruled": verdict})
    known = F.col("label").cast("int") if label else F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    # all pages of a path have the rule of the path, so a path either has a rule or needs the method
    paths = written(
        parsed.groupBy("host", "path", "ruled").agg(F.count(F.lit(1)).alias("n"), F.count(known).alias("known"), F.coalesce(F.sum(known), F.lit(0)).alias("bad"))
    )
    ways = written(templates(paths))
    bad = few(written(rejected(ways)))
    gone = few(written(ways.filter("ruled IS NULL").join(bad, ["host", "way"], "left_semi").select("host", "path", F.lit("block").alias("found"))))
    out = parsed.join(gone, ["host", "path"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "found", F.lit("allow")).alias("verdict"))
