"""Allow and block rules for URLs: expansion, equality on short hash prefixes, confirmation by full digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, own_name

#: Hex digits of the digest that the join compares first.
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """Host in lower case (A-Z), up to the first ``/``, ``?`` or ``#`` after ``://``; empty without ``://``."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def parse_rules(rules: DataFrame, rule: str = "rule", action: str = "action") -> DataFrame:
    """Rules such as ``example.net/en/`` as ``rule, action, rule_host, rule_path``; rules without a host are left out."""
    host = lower_ascii(F.substring_index(F.col(rule), "/", 1))
    return (
        rules.select(F.col(rule).alias("rule"), F.col(action).alias("action"), host.alias("rule_host"), F.regexp_extract(rule, r"(?s)^[^/]*(.*)$", 1).alias("rule_path"))
        .where("rule_host <> ''")
        .groupBy("rule", "rule_host", "rule_path")
        .agg(F.max("action").alias("action"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows of ``pages`` with ``host, path, rule, verdict``.

    ``rules`` has ``rule`` (host, then path) and ``action``. A rule fits its host and all subdomains if the path starts with
    its path; of the fitting rules the longest wins, then the one with the longer host, then the larger text; of equal rules
    with two actions the larger action. Without a rule ``rule`` is NULL and ``verdict`` is ``default``. A NULL url or one
    without ``://`` has an empty host and path and fits no rule. Columns of ``pages`` that have one of the new names keep
    their place under that name with underscores in front.

    A URL is expanded to host suffixes x directories of its path, no more of either than the longest rule has. These
    expressions meet the rules in an equality join on the first digits of their digests; the full digest and the whole rule
    path are compared afterwards. Only distinct pairs of host and path are expanded; Spark broadcasts the rules if their
    measured size allows it and splits hot hosts otherwise.
    """
    for name in ("host", "path", "rule", "verdict"):
        if name in pages.columns:
            pages = pages.withColumnRenamed(name, own_name(name, [*pages.columns, "host", "path", "rule", "verdict"]))
            url = own_name(name, [*pages.columns]) if url == name else url
    parsed = parse_rules(rules)
    most = parsed.agg(F.max(F.size(F.split("rule_host", r"\."))), F.max(F.size(F.split("rule_path", "/")))).first()
    labels, folders = most[0] or 1, most[1] or 1
    folder = F.regexp_extract("rule_path", r"(?s)^.*/", 0)
    keyed = parsed.withColumn("digest", F.sha2(F.concat("rule_host", F.lit(" "), folder), 256))
    keyed = keyed.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))

    judged = pages.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    distinct = judged.select("host", "path").where("host <> ''").distinct()
    expressions = (
        distinct.withColumn("_labels", F.split("host", r"\.")).withColumn("_parts", F.split("path", "/"))
        .withColumn("_suffix", F.explode(F.expr(f"transform(sequence(1, least(size(_labels), {labels})), n -> array_join(slice(_labels, -n, n), '.'))")))
        .withColumn("_folder", F.explode(F.expr(f"transform(sequence(0, least(size(_parts) - 1, {folders})), n -> if(n = 0, '', concat(array_join(slice(_parts, 1, n), '/'), '/')))")))
        .select("host", "path", F.sha2(F.concat("_suffix", F.lit(" "), "_folder"), 256).alias("full"))
        .withColumn("short", F.substring("full", 1, PREFIX_DIGITS))
    )
    best = (
        expressions.join(keyed, "short")
        .where("full = digest AND startswith(path, rule_path)")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("size"), F.length("rule_host").alias("host_size"), "rule", "action")).alias("_best"))
        .select("host", "path", F.col("_best.rule").alias("rule"), F.col("_best.action").alias("verdict"))
    )
    return judged.join(best, ["host", "path"], "left").select(*pages.columns, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
