"""URL rules by host-suffix and path-prefix expressions: hash prefixes retrieve, full digests and precedence decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and path up to ``?`` or ``#``; both empty without ``://`` or for null."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _short(digest: Column) -> Column:
    """The first 32 bits of a digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Per page row: page_id, host, path, rule (host and path of the rule, or null), verdict.

    Rules (host, path, verdict) hold for a host and all its subdomains where the path starts with the rule's. Every
    distinct url is expanded into its host suffixes, each with the path's prefixes of lengths that rules have; the
    expressions meet rules by 32 bits of their digest, then the full digest must agree. The longest rule wins, of
    equally long ones the one with the longer host, then block. Rules with a null are left out; a page with null url
    has empty host and path. Pages with one url are judged once, so a url that a third of them share costs one row.
    """
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().dropna().collect()]  # a path is no longer than a url
    known = rules.dropna(subset=["host", "path", "verdict"]).select(
        F.struct(F.length(F.concat("host", "path")).alias("long"), F.length("host").alias("host_long"), (F.col("verdict") == "block").alias("block"), F.concat("host", "path").alias("rule"), "verdict").alias("found"),
        _digest(F.concat_ws("\n", "host", "path")).alias("rule_digest"),
    )
    known = known.withColumn("short", _short(F.col("rule_digest")))
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").filter(F.col("url").isNotNull()).distinct().select("url", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths))) if lengths else F.array().cast("array<string>")
    expressions = (
        urls.filter(F.col("host") != "").select("url", F.explode(suffixes).alias("host"), prefixes.alias("prefixes"))
        .select("url", "host", F.explode("prefixes").alias("prefix")).filter(F.col("prefix").isNotNull())
        .select("url", _digest(F.concat_ws("\n", "host", "prefix")).alias("digest"))
    )
    best = (
        expressions.withColumn("short", _short(F.col("digest"))).join(known, "short").filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("url").agg(F.max("found").alias("found"))
    )
    return pages.select("page_id", "url", host.alias("host"), path.alias("path")).join(best, "url", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.lit(default)).alias("verdict")
    )
