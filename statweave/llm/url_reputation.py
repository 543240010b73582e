"""URL filters: explicit rules, then empirical-Bayes host reputation.

A rule names a host and the beginning of a path; it fits that host and its
subdomains, and the longest fitting rule decides.  Urls without a rule are
judged by their host's record: labelled page outcomes (the document that a
page shows is of low quality or toxic) are counted by host, registered domain
and suffix, and each level's rate is shrunk towards the one above through a
beta-binomial prior whose concentration is estimated from the spread of the
rates at that level (moments, Kleinman 1973).  A host is blocked when the lower
bound of its posterior rate of bad pages is above ``MAX_BAD``.

All counts are aggregated by host before any join; the level above is joined
to the aggregated table, never to the pages.  Only the three concentrations and
the overall rate reach the driver.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule and is judged as the host ''; hosts without outcomes get their
domain's, suffix's or the overall prior; without any label every such url is
allowed; repeated rows are judged alike.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_checked, cut

# Fixed values: (verdict, rule).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
MAX_BAD = 0.5
# Standard deviations below the posterior mean (one-sided 95 %).
Z = 1.645
# The concentration lies within these bounds, in pages.
CONCENTRATION = (2.0, 1000.0)


def host_of(url: Column) -> Column:
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct (rule, verdict), or null."""
    found = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(
            "/" + rule_path)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def domain_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0)


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"[^.]*$", 0)


def concentration(level: DataFrame) -> float:
    """Prior strength in pages from the rates (bad, n) of one level."""
    t = level.filter("n > 0").agg(
        F.count("*").alias("m"), F.sum("n").alias("n"), F.sum("bad").alias("bad"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q")).first()
    low, high = CONCENTRATION
    if not t["m"] or t["m"] < 2 or not 0 < t["bad"] < t["n"]:
        return high
    mean = t["bad"] / t["n"]
    spread = t["q"] - t["bad"] * mean
    var = mean * (1 - mean)
    rho = (spread - var * (t["m"] - 1)) / (var * (t["n"] - t["nn"] / t["n"] - (t["m"] - 1)) or 1)
    return low if rho >= 1 / (1 + low) else high if rho <= 1 / (1 + high) else 1 / rho - 1


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Every host with its pages' outcomes: host, n labelled, bad."""
    shown = F.regexp_extract("path", r"([0-9]+)[^0-9]*$", 1).try_cast("long")
    per = pages.select("host", shown.alias("doc_id")).groupBy("host", "doc_id").agg(
        F.count("*").alias("pages"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("long")
    known = labels.select("doc_id", bad.alias("bad")).filter(
        "doc_id is not null and bad is not null").groupBy("doc_id").agg(F.max("bad").alias("bad"))
    return per.join(known, "doc_id", "left").groupBy("host").agg(
        F.sum(F.when(F.col("bad").isNotNull(), F.col("pages")).otherwise(0)).alias("n"),
        F.sum(F.coalesce(F.col("bad") * F.col("pages"), F.lit(0))).alias("bad"))


def reputation(hosts: DataFrame) -> DataFrame:
    """(host, n, bad) -> (host, rate, bound): posterior mean and lower bound."""
    hosts = cut(hosts.select("host", domain_of(F.col("host")).alias("domain"),
                             suffix_of(F.col("host")).alias("suffix"), "n", "bad"))
    domains = cut(hosts.groupBy("domain").agg(F.first("suffix").alias("suffix"),
                                              F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    suffixes = cut(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    overall = bad / n if n else 0.0

    def shrunk(prior: Column, strength: float) -> Column:
        return (prior * strength + F.col("bad")) / (F.lit(strength) + F.col("n"))
    s = suffixes.select("suffix", shrunk(F.lit(overall), concentration(suffixes)).alias("prior"))
    d = domains.join(broadcast_checked(s), "suffix").select(
        "domain", shrunk(F.col("prior"), concentration(domains)).alias("prior"))
    strength = concentration(hosts)
    h = hosts.join(broadcast_checked(d), "domain").select(
        "host", "n", shrunk(F.col("prior"), strength).alias("rate"))
    sd = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + strength + 1))
    return h.select("host", "rate", (F.col("rate") - Z * sd).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """page_id, host, path, rule, verdict, bound (of bad pages) of every page."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"),
                     path_of(F.col("url")).alias("path"))
    rep = broadcast_checked(cut(reputation(outcomes(p, labels))))
    found = longest_rule(F.col("host"), F.col("path"), rules)
    return p.join(rep, "host", "left").select(
        "page_id", "host", "path", found["rule"].alias("rule"),
        F.coalesce(found["verdict"], F.when(F.col("bound") > max_bad, "block").otherwise("allow"))
        .alias("verdict"), F.round("bound", 4).alias("bound"))


def keep(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """The page ids of allowed urls."""
    return judge(pages, labels, rules, max_bad).filter("verdict = 'allow'").select("page_id")
