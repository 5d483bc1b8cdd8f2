"""URL filter: host-suffix and path-prefix expressions against a rule list.

A rule (host, path, action) fits its host and all subdomains when the url's path starts
with the rule's path. Each distinct (host, path) of the pages is expanded into the
expressions that have the lengths some rule has; these meet the rules in an equi-join on
the first eight hex digits of a SHA-256 digest, and the whole digest confirms. The rule
with the longest host plus path wins (then the longer host, then ``allow``).

Only lengths that rules have are expanded, so a host of thousands of labels or a path of
megabytes costs no more than a short one. Null urls and urls without ``://`` have an
empty host and path and fit no rule; repeated rows are judged alike; an empty rule list
leaves the default verdict. Other columns of the pages are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import ascii_lower

#: What follows the first "://": the host, then the path.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_SHORT = 8


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # The length keeps ("a.b", "/c") apart from any other split of the same letters.
    return F.sha2(F.concat_ws("\n", F.length(host).cast("string"), host, path), 256)


def rule_table(spark, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules from (host, path, action) triples."""
    return spark.createDataFrame(list(rules), "host string, path string, action string")


def expand(targets: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """One row per (host, path) and fitting shape, with the digest of its expression."""
    host, path = F.col("host"), F.col("path")
    size = F.length(host)
    options = []
    for h, p in shapes:
        whole = (size == h) | ((size > h) & (F.substring(host, size - h, F.lit(1)) == "."))
        suffix = F.substring(host, size - h + 1, F.lit(h)) if h else F.lit("")
        fits = (F.lit(h > 0) & whole) & (F.length(path) >= p)
        options.append(F.when(fits, _digest(suffix, F.substring(path, 1, p))))
    return targets.select(
        "host", "path", F.explode(F.array_compact(F.array(*options))).alias("digest")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``key``, host, path, rule and verdict of every row of ``pages``."""
    known = (
        rules.where("host is not null and path is not null and action is not null")
        .select(ascii_lower(F.col("host")).alias("host"), "path", "action")
        .groupBy("host", "path")
        .agg(F.min("action").alias("action"))
        .select(
            _digest(F.col("host"), F.col("path")).alias("digest"),
            F.struct(
                (F.length("host") + F.length("path")).alias("size"),
                F.length("host").alias("host_size"),
                F.concat("host", "path").alias("rule"),
                "action",
            ).alias("found"),
        )
        .withColumn("short", F.left("digest", F.lit(_SHORT)))
    )
    # One row per pair of lengths, whatever the number of rules.
    shapes = sorted(
        (r.h, r.p)
        for r in rules.where("host is not null and path is not null and action is not null")
        .select(F.length("host").alias("h"), F.length("path").alias("p"))
        .distinct()
        .collect()
    )
    urls = pages.select(
        F.col(key).alias("key"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    )
    none = F.lit(None).cast("string")
    if not shapes:
        return urls.select(
            F.col("key").alias(key), "host", "path", none.alias("rule"), F.lit(default).alias("verdict")
        )
    asked = expand(urls.select("host", "path").distinct(), shapes).withColumn(
        "short", F.left("digest", F.lit(_SHORT))
    )
    best = (
        asked.alias("a")
        .join(known.alias("k"), F.col("a.short") == F.col("k.short"))
        .where("a.digest = k.digest")
        .groupBy("a.host", "a.path")
        .agg(F.max("k.found").alias("found"))
    )
    return urls.join(best, ["host", "path"], "left").select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.action", F.lit(default)).alias("verdict"),
    )
