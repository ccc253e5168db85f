"""URL filters: host-suffix and path-prefix expressions met by hash prefix.

Each rule is (action, host, path).  A rule fits its host and every subdomain,
for paths that start with its path.  Each url is expanded into those of its
host suffixes and path prefixes whose shape (labels, path length) some rule
has; url and rule expressions are joined on the first 32 bits of SHA-256, the
full digests are then compared, and the longest rule string wins (at equal
length the longer host, then block over allow).  Urls without a fitting rule
get the default.

A null url, or one without ``://``, has an empty host and path.  Repeated
pages are judged each.  Long urls are judged whole: only as many expressions as
rules have shapes are made of one.  An empty table gives an empty result; no
rules, the default throughout.  Rules with a null part are left out.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER
from .scratch import small, stored

RULE_SCHEMA = "action string, host string, path string"


def host_of(url: Column) -> Column:
    """Host of an url: between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """Path of an url: from the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id", default: str = "allow") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``."""
    rules = stored(
        rules.dropna().select("action", F.translate("host", UPPER, LOWER).alias("host"), "path").distinct()
        .withColumn("rule", F.concat("host", "path"))
        .withColumn("digest", _digest(F.col("host"), F.col("path")))
        .withColumn("short", F.substring("digest", 1, 8)),
        "rules",
    )
    # One row: the label counts and path lengths that rules have.
    shapes = rules.agg(F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"), F.sort_array(F.collect_set(F.length("path"))).alias("lengths"))
    labels, lengths = shapes.first() or ([], [])
    rows = pages.select(
        F.monotonically_increasing_id().alias("uid"), F.col(key).alias("page_id"),
        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
    )
    own = F.size(F.split("host", r"\."))
    suffixes = F.filter(F.array(*(F.when(own >= n, F.substring_index("host", ".", -n)) for n in labels)).cast("array<string>"), lambda x: x.isNotNull())
    prefixes = F.filter(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)).cast("array<string>"), lambda x: x.isNotNull())
    opened = rows.withColumn("suffix", F.explode_outer(suffixes)).withColumn("prefix", F.explode_outer(prefixes))
    opened = opened.withColumn("full", _digest(F.col("suffix"), F.col("prefix"))).withColumn("short", F.substring("full", 1, 8))
    met = opened.join(small(rules.select("short", "digest", "rule", "action", F.col("host").alias("rule_host"))), "short", "left")
    confirmed = F.col("digest") == F.col("full")
    best = F.max(F.when(confirmed, F.struct(F.length("rule").alias("a"), F.length("rule_host").alias("b"), (F.col("action") == "block").alias("c"), F.col("rule"), F.col("action"))))
    return met.groupBy("uid", "page_id", "host", "path").agg(best.alias("best")).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict")
    )
