"""URL rules by a sort-merge range join on reversed-host canonical keys.

A rule (host, path prefix) fits its host and every subdomain. The canonical key is the host's labels from
the top down, then the path, so all paths that a rule fits at one host level are one interval of keys.
A URL stands once at each level that has rules. Rules and URLs of a level are sorted by key; the sweep
carries the stack of nested rules that are open (a rule and those whose path is a prefix of its own), and the
longest one on the stack that still encloses the URL wins there. Over all levels the longest rule wins; at
equal length the one with the longer host.

* Distinct (host, path) pairs are judged once and joined back, so repeated URLs cost one row. Only host
  levels that have rules go on, at most as many per URL as the deepest rule has labels.
* A level with many URLs is dealt to ``ceil(urls / spread)`` sweeps by a hash of the URL; its rules go to each.
* Null URLs and URLs without ``://`` have an empty host and path. What no rule fits gets ``default``.
  Repeated rows are each judged; a rule given twice counts once, blocking if the two disagree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """page_id, host and path; the host in lower case (A-Z only)."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    split = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    return split.select(
        "page_id",
        F.translate(host, _UPPER, _LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def reversed_host(labels: Column) -> Column:
    return F.concat_ws(".", F.reverse(labels))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(level, path, stack): a rule with itself and the rules of its host that enclose it."""
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    keyed = rules.select(reversed_host(F.split("host", r"\.")).alias("level"), "host", "path", "verdict")
    inner = keyed.select(
        "level", "path", F.explode(F.expr("sequence(0, length(path))")).alias("n")
    ).selectExpr("level", "path", "left(path, n) as outer_path")
    outer = keyed.select("level", F.col("path").alias("outer_path"), "host", "verdict")
    opened = F.struct(
        F.expr("length(host) + length(outer_path)").alias("size"),
        F.length("host").alias("host_size"),
        F.concat("host", "outer_path").alias("rule"),
        F.col("outer_path").alias("prefix"),
        "verdict",
    )
    return (
        inner.join(outer, ["level", "outer_path"])
        .groupBy("level", "path")
        .agg(F.collect_list(opened).alias("stack"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", spread: int = 100_000) -> DataFrame:
    """page_id, host, path, rule, verdict for every page; ``rules`` has host, path and verdict."""
    urls = parsed(pages)
    stacks = rule_stacks(rules)
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    targets = urls.where("host <> ''").select("host", "path").distinct()
    levels = targets.select(
        "host",
        "path",
        F.explode(
            F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1))))
        ).alias("n"),
    ).withColumn("level", F.expr("array_join(slice(reverse(split(host, '[.]')), 1, n), '.')"))
    ruled = levels.join(stacks.select("level").distinct(), "level", "left_semi")
    spreads = ruled.groupBy("level").agg(F.expr(f"1 + count(1) div {int(spread)}").alias("parts"))
    dealt = ruled.join(spreads, "level").select(
        "level",
        F.expr("pmod(xxhash64(host, path), parts)").alias("part"),
        "path",
        F.lit(1).alias("kind"),
        "host",
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
    )
    opened = stacks.join(spreads, "level").select(
        "level",
        F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"),
        "path",
        F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("host"),
        "stack",
    )
    sweep = Window.partitionBy("level", "part").orderBy("path", "kind").rowsBetween(Window.unboundedPreceding, 0)
    fitting = F.filter("open", lambda r: F.col("path").startswith(r["prefix"]))
    best = (
        opened.unionByName(dealt)
        .withColumn("open", F.last("stack", ignorenulls=True).over(sweep))
        .where("kind = 1")
        .select("host", "path", F.array_max(fitting).alias("found"))
        .where("found is not null")
        .groupBy("host", "path")
        .agg(F.max("found").alias("found"))
    )
    return urls.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )
