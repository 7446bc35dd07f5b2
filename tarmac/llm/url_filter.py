"""URL filters: written rules first, then the host's reputation by empirical Bayes.

Labelled outcomes of pages are counted by host, registered domain and suffix. Each level is a
beta-binomial whose prior mean is the posterior mean of the level above and whose strength is
estimated from the level's own spread (method of moments). A host is blocked once the lower
posterior bound of its rate of bad pages reaches the limit, so little evidence never blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.columns import lower_ascii

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Bounds of the estimated correlation of outcomes below one node (strengths 999 down to 0.25).
LEAST_CORRELATION, MOST_CORRELATION = 0.001, 0.8


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(host, slash + path, verdict)

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; '' without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def url_path(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)


def match_rules(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else NULL. Rules are a short, written list."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = _fits(rule, host, path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _bare(host: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def registered_domain(host: Column) -> Column:
    """The last two labels of a host, without user and port."""
    return F.regexp_extract(_bare(host), r"([^.]*\.)?[^.]*$", 0)


def suffix(host: Column) -> Column:
    return F.regexp_extract(_bare(host), r"[^.]*$", 0)


def _strength(nodes: DataFrame) -> float:
    """Prior strength of a level from its nodes (n, k, prior), weakest without evidence: one row of sums."""
    m = F.col("prior")
    own = m * (1 - m)
    sums = nodes.agg(
        F.sum(F.pow(F.col("k") - F.col("n") * m, 2) - F.col("n") * own).alias("extra"),
        F.sum(F.col("n") * (F.col("n") - 1) * own).alias("pairs"),
    ).first()
    ratio = (sums.extra / sums.pairs) if sums.pairs else MOST_CORRELATION
    ratio = min(max(ratio, LEAST_CORRELATION), MOST_CORRELATION)
    return 1 / ratio - 1


def _posterior(nodes: DataFrame, *keep: str) -> DataFrame:
    """Posterior mean and variance of each node as ``prior`` and ``prior_variance``.

    The variance has two parts: the node's own beta, and as much of its prior mean's as counts.
    """
    strength = _strength(nodes)
    n, k, prior = F.col("n"), F.col("k"), F.col("prior")
    mean = (k + strength * prior) / (n + strength)
    variance = mean * (1 - mean) / (n + strength + 1) + F.pow(strength / (n + strength), 2) * F.col("prior_variance")
    others = keep or [c for c in nodes.columns if c not in ("prior", "prior_variance")]
    return nodes.select(*others, mean.alias("prior"), variance.alias("prior_variance"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """One row per host of ``pages`` (page_id, url): labelled pages, bad ones, mean and bounds.

    ``outcomes`` has page_id and bad (0 or 1); NULLs in either are left out, and of several rows
    for a page the worst counts. A host without labels has its domain's posterior as a prior.
    Hosts are counted before anything is joined, so a hot host is one row.
    """
    worst = outcomes.filter(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy(
        F.col("page_id").alias("outcome_id")).agg(F.max("bad").alias("bad"))
    seen = pages.select("page_id", url_host("url").alias("host"))
    hosts = (
        seen.join(worst, seen["page_id"] == worst["outcome_id"], "left").groupBy("host")
        .agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))
        .withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix(F.col("host")))
    )
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    total = suffixes.agg(*sums).first()
    overall = ((total.k or 0.0) + 0.5) / ((total.n or 0.0) + 1.0)

    suffixes = suffixes.withColumn("prior", F.lit(overall)).withColumn("prior_variance", F.lit(0.0))
    domains = domains.join(_posterior(suffixes, "suffix"), "suffix")
    hosts = _posterior(hosts.join(_posterior(domains, "domain"), "domain"))
    mean, spread = F.col("prior"), z * F.sqrt("prior_variance")
    return hosts.select(
        "host", "domain", "suffix", F.col("n").cast("long").alias("labelled"), F.col("k").cast("long").alias("bad"),
        mean.alias("bad_rate"), F.greatest(mean - spread, F.lit(0.0)).alias("lower"),
        F.least(mean + spread, F.lit(1.0)).alias("upper"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], block_at: float = 0.3, z: float = 1.645,
) -> DataFrame:
    """Every page's url with host, path, the rule that fits and the verdict.

    A NULL url, or one without ``://``, has an empty host and path; all such pages share the
    reputation of the empty host. Rows are neither merged nor lost: repeated pages are repeated.
    """
    hosts = host_reputation(pages, outcomes, z).select(
        F.col("host").alias("known"), "labelled", "bad_rate", "lower")
    host, path = url_host("url"), url_path("url")
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    joined = judged.join(hosts, judged["host"] == hosts["known"], "left")
    text, ruled = match_rules(rules, F.col("host"), F.col("path"))
    by_method = F.when(F.col("lower") >= block_at, "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(ruled, by_method).alias("verdict"),
        "labelled", F.round("bad_rate", 6).alias("bad_rate"))
