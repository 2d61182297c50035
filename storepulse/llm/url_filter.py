"""URL filters by rules and empirical-Bayes host reputation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from storepulse.llm.common import written

# A-Z and what they become.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Second levels under which two-letter countries register names, and hosts
# whose subdomains are registrants of their own. A short list, not the public suffix list.
LEVELS = ("ac", "co", "com", "edu", "go", "gov", "ne", "net", "or", "org")
PLATFORMS = ("blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev",
             "substack.com", "vercel.app", "web.app", "wordpress.com")
SUFFIX = r"(?:(?:{})\.[a-z][a-z]|{}|[^.]*)\z".format(
    "|".join(LEVELS), "|".join(p.replace(".", r"\.") for p in PLATFORMS))
# The parent of all hosts that are addresses; no name has a parenthesis.
ADDRESSES = "(address)"
# A host is blocked if even the upper bound of its rate of good pages is below this.
LEAST_GOOD = 0.5
# Standard deviations from the posterior mean to its bound.
BOUND = 1.645
# Bounds of the estimated correlation within a group; 1 / (rho) - 1 pages of prior.
RHO = (0.01, 0.9)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rules(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; NULL where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def name_of(host: Column) -> Column:
    """The host without user and port, which the rules see and reputation does not."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*\z", "")


def is_address(name: Column) -> Column:
    return name.rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*\])\z")


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and the label before it; an address is its own."""
    name = name_of(host)
    return F.when(is_address(name), name).otherwise(
        F.regexp_extract(name, r"([^.]*\.)?" + SUFFIX, 0))


def suffix_of(host: Column) -> Column:
    """What domains are registered under: the last label, or two where those are one level."""
    name = name_of(host)
    return F.when(is_address(name), ADDRESSES).otherwise(
        F.regexp_extract(name, r"(^|\.)(" + SUFFIX + ")", 2))


def prior_pages(groups: DataFrame) -> float:
    """The pages that a group's prior is worth; one number for all groups.

    By moments: with rho the correlation of outcomes within a group, the squared
    deviation of ``good`` from ``pages * mean`` is ``pages v (1 + (pages - 1) rho)``.
    """
    spread = F.pow(F.col("good") - F.col("pages") * F.col("mean"), 2)
    v = F.col("mean") * (1 - F.col("mean"))
    excess = F.sum(spread - F.col("pages") * v)
    scale = F.sum(F.col("pages") * (F.col("pages") - 1) * v)
    rho = F.greatest(F.least(F.coalesce(excess / F.nullif(scale, F.lit(0.0)), F.lit(0.0)),
                             F.lit(RHO[1])), F.lit(RHO[0]))
    return groups.agg(((1 - rho) / rho).alias("prior")).first().prior


def shrunk(groups: DataFrame) -> DataFrame:
    """Groups with the posterior ``rate`` and ``weight`` given the mean of their parent."""
    prior = prior_pages(groups)
    weight = F.col("pages") + prior
    return groups.withColumn(
        "rate", (F.col("good") + prior * F.col("mean")) / weight
    ).withColumn("weight", weight)


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """``host, rate, weight, upper`` from labelled pages.

    ``outcomes`` has a row per host or page: ``host, pages, good`` (labelled pages and the
    good ones of them; unlabelled hosts with 0). Beta-binomial priors go from all pages to
    the suffix, from there to the registered domain, from there to the host; how many
    pages a prior counts for is estimated from the spread of the groups. A host without
    labelled pages has its domain's rate, and no labels at all give 0.5.
    """
    hosts = outcomes.groupBy("host").agg(F.sum("pages").alias("pages"),
                                         F.sum("good").alias("good"))
    hosts = written(
        hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}),
        "host-outcomes",
    )
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("pages").alias("pages"),
                                                    F.sum("good").alias("good"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("pages").alias("pages"),
                                           F.sum("good").alias("good"))
    overall = suffixes.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1)
                            / (F.coalesce(F.sum("pages"), F.lit(0)) + 2)).alias("mean")).first().mean
    suffixes = shrunk(suffixes.withColumn("mean", F.lit(overall)))
    domains = shrunk(domains.join(
        suffixes.select("suffix", F.col("rate").alias("mean")), "suffix"))
    hosts = shrunk(hosts.join(
        domains.select("domain", F.col("rate").alias("mean")), "domain"))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return hosts.select("host", "rate", "weight",
                        (F.col("rate") + BOUND * deviation).alias("upper"))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, good_rate, good_upper`` of every page.

    Reads ``page_id, url``; other columns are ignored, whatever their names. The rule's
    verdict stands where a rule fits. The pages it stands for are the labelled outcomes
    that the reputation of hosts is learned from; every other page is blocked if its
    host's posterior upper bound is below ``LEAST_GOOD``, so a host nobody knows much
    about is allowed.

    NULL and malformed urls have an empty host and path; the empty host is a host.
    Repeated rows count as pages of their own. No rows give no rows.

    Pages are counted per host before anything is shuffled; the join back to the pages
    carries no html, and Spark splits a hot host's pages in it.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = by_rules(rules, F.col("host"), F.col("path"))
    ruled = parsed.withColumns({"rule": rule, "ruled": verdict})
    outcomes = ruled.select(
        "host", F.col("ruled").isNotNull().cast("long").alias("pages"),
        F.coalesce(F.col("ruled") == "allow", F.lit(False)).cast("long").alias("good"),
    )
    known = host_reputation(outcomes).withColumnsRenamed(
        {"rate": "good_rate", "upper": "good_upper"})
    learned = F.when(F.col("good_upper") < LEAST_GOOD, "block").otherwise("allow")
    return ruled.join(known, "host").select(
        "page_id", "host", "path", "rule",
        F.coalesce(F.col("ruled"), learned).alias("verdict"), "good_rate", "good_upper",
    )
