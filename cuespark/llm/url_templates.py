"""URL filters by a path-template tree (8).

Explicit rules come first: a rule ``host/path`` fits its host and all
subdomains if the path starts with the rule's; the longest that fits decides.
Other urls get the verdict of their template.

Templates form one tree per host over path segments, as deep as the paths.
Digits and long hexadecimal runs are wildcards from the start; then, level by
level, a segment becomes the wildcard ``{*}`` if its node has too many distinct
children, or if its share of bad labelled urls does not differ significantly
from its siblings' (a two-proportion test on the labels below them).  Leaves
are rejected when their smoothed share of bad labels, pulled towards the
host's and that towards the whole table's, is above ``MAX_BAD``.  Below
``DEPTH`` levels a branch without labels ends in ``{**}``: all its templates
would have the host's share.

DataFrame functions only.  Pages are pre-aggregated to distinct (host, path
with wildcards) before anything else; each level joins two written tables, so
a host with a third of all rows can be split by adaptive execution.  Below
``DEPTH``, a step of the loop takes every node to its next fork at once, so the
number of steps is that of forks on a labelled path, not its length.

Defined results: a null url, and one without ``://``, has an empty host and
path and is judged with the others of that kind; without labels nothing is blocked by templates; repeated
rows give repeated results; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .lines import ascii_lower

DEPTH = 5           # levels that branches without labels have too
MAX_CHILDREN = 20   # distinct children of a node, if at least half its visits
CRITICAL = 3.84     # chi-square, one degree of freedom, 5 %
PRIOR = 5           # labelled urls that the host's share counts for
MAX_BAD = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return ascii_lower(part(1)), part(2)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule of ``(verdict, rule)``
    pairs; null if none fits."""
    text = verdict = F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[0])):  # the longest is tested first
        at, start = rule.split("/", 1)
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + start)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, decision).otherwise(verdict)
    return text, verdict


def _segments(path: Column) -> Column:
    """Path segments with digits and long hexadecimal runs as wildcards."""
    s = F.when(path.startswith("/"), F.split(F.substring(path, 2, 1 << 30), "/")).otherwise(F.split(path, "/"))
    s = F.when(path == "", F.array().cast("array<string>")).otherwise(s)
    return F.transform(s, lambda x: F.regexp_replace(F.regexp_replace(x, "[0-9a-fA-F-]{16,}", "{h}"), "[0-9]+", "{n}"))


def _generalised(t: DataFrame) -> DataFrame:
    """``t`` with segment number ``at`` appended to ``prefix``, where there is
    one."""
    child = F.get("segments", F.col("at"))
    kids = materialize(t.where(F.size("segments") > F.col("at")).groupBy("host", "prefix", child.alias("child"))
                       .agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("bad").alias("bad")), "url-children")
    node = materialize(kids.groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("all_n"),
                                                          F.sum("known").alias("all_known"), F.sum("bad").alias("all_bad")), "url-nodes")
    rest, rest_bad = F.col("all_known") - F.col("known"), F.col("all_bad") - F.col("bad")
    p = F.try_divide("all_bad", "all_known")
    apart = F.try_divide("bad", "known") - F.try_divide(rest_bad, rest)
    spread = p * (1 - p) * (F.try_divide(F.lit(1), "known") + F.try_divide(F.lit(1), rest))
    differs = F.coalesce(F.try_divide(apart * apart, spread) >= CRITICAL, F.lit(False))
    many = (F.col("kids") >= MAX_CHILDREN) & (F.col("kids") * 2 >= F.col("all_n"))
    shown = F.when((F.col("kids") > 1) & (many | ~differs), "{*}").otherwise(F.col("child"))
    chosen = materialize(kids.join(node, ["host", "prefix"]).select("host", "prefix", "child", shown.alias("shown")), "url-chosen")
    t = t.withColumn("child", child).join(chosen, ["host", "prefix", "child"], "left")
    t = t.withColumn("prefix", F.when(F.col("shown").isNull(), F.col("prefix")).otherwise(F.concat_ws("/", "prefix", "shown")))
    return t.withColumn("at", F.when(F.col("shown").isNull(), F.col("at")).otherwise(F.col("at") + 1)).drop("child", "shown")


def _at_forks(t: DataFrame) -> DataFrame:
    """``t`` with the segments appended that all open paths of a node share
    (what the least and the greatest path share, all share); nodes without
    labels below them end."""
    rest = F.slice("segments", F.col("at") + 1, F.size("segments"))
    is_open = F.size("segments") > F.col("at")
    nodes = t.where(is_open).groupBy("host", "prefix").agg(F.min(rest).alias("lo"), F.max(rest).alias("hi"), F.sum("known").alias("below"))
    apart = F.array_position(F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b)), False)
    shared = F.when(apart == 0, F.size("lo")).otherwise(apart - 1).cast("int")
    nodes = materialize(nodes.select("host", "prefix", "below", F.slice("lo", 1, shared).alias("shared")), "url-forks")
    t = t.join(nodes.withColumn("forked", F.lit(True)), ["host", "prefix"], "left")
    ends, goes = is_open & (F.col("below") == 0), is_open & F.col("forked")
    prefix = F.when(ends, F.concat_ws("/", "prefix", F.lit("{**}"))).when(goes, F.concat_ws("/", "prefix", "shared")).otherwise(F.col("prefix"))
    at = F.when(ends, F.size("segments")).when(goes, F.col("at") + F.size("shared")).otherwise(F.col("at"))
    return t.select("host", "segments", "n", "known", "bad", prefix.alias("prefix"), at.alias("at"))


def _shared(bad: Column, known: Column, prior: Column) -> Column:
    return (bad + PRIOR * prior) / (known + PRIOR)


def template_tree(pages: DataFrame, url: str = "url", bad: str = "bad") -> DataFrame:
    """``host``, ``key`` (path with lexical wildcards), ``template``, the
    labelled and bad urls of the template, its smoothed share ``rate`` of bad
    ones, ``blocked``.  ``bad``: 1, 0, or null where there is no label."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(host.alias("host"), _segments(path).alias("segments"), F.col(bad).cast("long").alias("bad"))
    t = rows.groupBy("host", "segments").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("known"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    t = materialize(t.withColumn("prefix", F.lit("")).withColumn("at", F.lit(0)), "url-paths")
    depth = t.agg(F.max(F.size("segments"))).first()[0] or 0
    for _ in range(min(depth, DEPTH)):
        t = materialize(_generalised(t), "url-level")
    while depth > DEPTH and not t.where(F.size("segments") > F.col("at")).isEmpty():
        t = materialize(_at_forks(t), "url-fork")
        t = materialize(_generalised(t), "url-level")
    every = t.agg(F.sum("bad").alias("bad"), F.sum("known").alias("known")).first()
    overall = F.lit((every.bad or 0) / (every.known or 1))
    hosts = t.groupBy("host").agg(_shared(F.sum("bad"), F.sum("known"), overall).alias("host_rate"))
    leaves = t.groupBy("host", "prefix").agg(F.sum("known").alias("known"), F.sum("bad").alias("bad")).join(hosts, "host")
    leaves = leaves.withColumn("rate", _shared(F.col("bad"), F.col("known"), F.col("host_rate"))).drop("host_rate")
    leaves = materialize(leaves, "url-leaves")
    return t.select("host", F.array_join("segments", "/").alias("key"), F.size("segments").alias("size"), "prefix").join(leaves, ["host", "prefix"]).select(
        "host", "key", "size", F.col("prefix").alias("template"), "known", "bad", "rate", (F.col("rate") > MAX_BAD).alias("blocked"))


def judge(pages: DataFrame, rules=(), url: str = "url", bad: str = "bad", keep=None) -> DataFrame:
    """Struct ``row`` of the ``keep`` columns (all) of every page row, its
    ``host``, ``path``, ``rule``, ``template``, ``rate`` and ``verdict``."""
    tree = materialize(template_tree(pages, url, bad), "url-templates")
    host, path = host_and_path(F.col(url))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.struct(*(keep or pages.columns)).alias("row"), host.alias("host"), path.alias("path"))
    rows = rows.select("row", "host", "path", text.alias("rule"), verdict.alias("_ruled"), _segments(F.col("path")).alias("_s"))
    rows = rows.withColumn("_key", F.array_join("_s", "/")).withColumn("_size", F.size("_s")).drop("_s")
    tree = tree.select(F.col("host").alias("_host"), "key", "size", "template", "rate", "blocked")
    rows = rows.join(tree, (F.col("host") == F.col("_host")) & (F.col("_key") == F.col("key")) & (F.col("_size") == F.col("size")), "left")
    return rows.select("row", "host", "path", "rule", "template", "rate",
                       F.coalesce("_ruled", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))


def report(pages: DataFrame, rules=(), page_id: str = "page_id", **options) -> DataFrame:
    rows = judge(pages, rules, keep=[page_id], **options)
    return rows.select(F.col("row")[page_id].alias(page_id), "host", "path", "rule", "verdict", "template")
