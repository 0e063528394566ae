"""URL filters: host-suffix and path-prefix expressions against rules of (host, path).

Every URL is expanded into the expressions a rule could have: each suffix of its host, by
labels, with each prefix of its path of a length that some rule has. Expressions and rules
meet on four bytes of their SHA-256, and the full digests confirm. Different URLs with one
host and path are judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.staging import stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) after the first ``://``, and the path; else both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(F.regexp_replace(rest, "(?s)[?#].*$", ""), F.lit(""))
    slash = F.locate("/", rest)
    host = F.when(slash > 0, rest.substr(F.lit(1), slash - 1)).otherwise(rest)
    path = F.when(slash > 0, rest.substr(slash, F.length(rest))).otherwise("")
    return F.translate(host, _UPPER, _UPPER.lower()), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per row of ``pages``.

    ``pages`` needs ``page_id`` and ``url``; ``rules`` are ``(verdict, host, path)``. A rule
    fits its host and all subdomains of it, if the path starts with the rule's. Of the
    rules that fit, the one with the longest host and path together wins, then the longer
    host; of a rule that stands for both verdicts, ``block`` wins. Without one, ``rule``
    is null and the verdict ``default``.

    A null url, or one without ``://``, has an empty host and path; so has nothing after
    ``://``. An empty path starts with no rule's path but an empty one. Repeated rows and
    null page_ids are judged like any other.
    """
    host, path = host_and_path(F.col("url"))
    # native types may differ for a url that is not text
    targets = pages.select("page_id", host.alias("host"), path.alias("path"))
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.col("verdict").alias("rule_verdict"),
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
    )
    rules = rules.withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path"))).withColumn(
        "short", F.substring("digest", 1, 8)
    )
    lengths = rules.agg(F.collect_set(F.length("rule_path"))).first()[0]

    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.filter(
        F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths))).cast("array<string>"),
        lambda prefix: prefix.isNotNull(),
    )
    expressions = (
        targets.select("host", "path").where("host <> ''").distinct()
        .select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(prefixes).alias("prefix"))
        .withColumn("own", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", F.substring("own", 1, 8))
    )
    name = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(name), F.length("rule_host"), F.col("rule_verdict") == "block", name, "rule_verdict"))
    judged = (
        expressions.join(rules, "short").where("own = digest")
        .groupBy("host", "path").agg(best.alias("best"))
        .select("host", "path", F.col("best.col4").alias("rule"), F.col("best.rule_verdict").alias("judged"))
    )
    # written, so that the join can split the rows of a frequent url
    judged = stored(judged, "judged")
    return targets.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("judged", F.lit(default)).alias("verdict")
    )
