"""URL filtering by empirical-Bayes reputation of hosts.

Labelled page outcomes (good or not) are counted by host, registered domain and
suffix. Each level is a beta-binomial whose prior mean is the posterior mean of
the level above, and whose prior strength is estimated from how far its members
scatter (method of moments). A host is allowed if the lower bound of its
posterior, mean - z sd, reaches a limit; a host without outcomes has the bound
of what lies above it. Rules for hosts and paths go first.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import staged

#: Lower bound of the share of good pages from which a host is allowed, and z of the bound.
LIMIT, Z = 0.7, 1.645
#: Bounds of the scatter within a level (1 / (strength + 1)).
SCATTER = (0.001, 0.5)


def parts_of(url: str) -> tuple[Column, Column]:
    """Host: after the first '://' up to '/', '?', '#' or the end, A-Z in lower case; path: then up to '?', '#' or the end. Otherwise empty."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(text, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, pattern, 2)


def domain_of(host: Column) -> Column:
    """The last two labels of a host without its port."""
    return F.substring_index(F.regexp_replace(host, r":[0-9]*$", ""), ".", -2)


def suffix_of(domain: Column) -> Column:
    return F.substring_index(domain, ".", -1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule (host and path as text) and its verdict for the longest of ``rules`` (verdict, host, path) that fits; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _strength(free: float, total: float, shared: float, spread: float, noise: float) -> float:
    """Strength of a level's prior by the method of moments: what scatter there is beyond that of the counts."""
    unit = noise / total if total else 0.0
    room = unit * (total - shared - free)
    scatter = min(max((spread - unit * free) / room, SCATTER[0]), SCATTER[1]) if room > 0 else SCATTER[1]
    return 1 / scatter - 1


def _level(members: DataFrame, own: str, above: str, parents: DataFrame) -> DataFrame:
    """Members (``own``, ``above``, ``n``, ``k``) with ``a`` and ``b`` of their posterior and its mean ``m``; ``parents`` has ``above`` and ``prior``."""
    joined = members.join(parents, above)
    variance = F.col("prior") * (1 - F.col("prior"))
    seen = joined.filter("n > 0")
    inner = seen.groupBy(above).agg(
        F.count(F.lit(1)).alias("members"),
        F.sum("n").alias("all"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("prior"), 2)).alias("spread"),
        F.sum(F.col("n") * variance).alias("noise"),
    )
    total = inner.agg(
        F.sum(F.col("members") - 1).alias("free"), F.sum("all").alias("all"), F.sum(F.col("squares") / F.col("all")).alias("shared"), F.sum("spread").alias("spread"), F.sum("noise").alias("noise")
    )
    strength = F.lit(_strength(*[x or 0.0 for x in total.first()]))
    a, b = strength * F.col("prior") + F.col("k"), strength * (1 - F.col("prior")) + F.col("n") - F.col("k")
    return joined.select(own, a.alias("a"), b.alias("b"), (a / (a + b)).alias("m"))


def reputation(outcomes: DataFrame) -> DataFrame:
    """``outcomes`` (``host``; ``good`` 1, 0 or null where unknown) to ``host``, ``mean``, ``bound``; one row for each host.

    Counts are combined before they are shuffled, so a host with a third of all pages is one row for each task.
    """
    good = F.col("good").cast("long")
    hosts = outcomes.groupBy("host").agg(F.count(good).alias("n"), F.coalesce(F.sum(good), F.lit(0)).alias("k")).withColumn("domain", domain_of(F.col("host")))
    hosts = staged(hosts, "hosts")
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("suffix", suffix_of(F.col("domain")))
    domains = staged(domains, "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("root", F.lit(0))
    root = suffixes.groupBy("root").agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("prior"))
    by_suffix = staged(_level(suffixes, "suffix", "root", root).select("suffix", F.col("m").alias("prior")), "suffixes")
    by_domain = staged(_level(domains, "domain", "suffix", by_suffix).select("domain", F.col("m").alias("prior")), "domains")
    size = F.col("a") + F.col("b")
    deviation = F.sqrt(F.col("a") * F.col("b") / (size * size * (size + 1)))
    return _level(hosts, "host", "domain", by_domain).select("host", F.col("m").alias("mean"), (F.col("m") - Z * deviation).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id", url: str = "url", limit: float = LIMIT) -> DataFrame:
    """One row for every page: ``key``, ``host``, ``path``, ``rule``, ``verdict``.

    ``outcomes``: ``key``, ``good``; several rows for a page count each, pages without one count for no outcome. Null
    urls and urls without '://' have the empty host, which is judged like any
    other. Repeated pages repeat; extra columns play no part.
    """
    host, path = parts_of(url)
    parsed = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    known = outcomes.select(F.col(key).alias("__key"), "good").filter(F.col("good").isNotNull())
    counted = parsed.select("host", F.col(key).alias("__key")).join(known, "__key", "left").select("host", "good")
    bounds = reputation(counted).select("host", "bound")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= limit, F.lit("allow")).otherwise(F.lit("block"))
    return parsed.join(bounds, "host").select(key, "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))
