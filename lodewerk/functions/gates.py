"""Gates on single records, as column builders: null is false unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import exprs as E

MAX_DOMAINS, MAX_IPS, MAX_HASHES, MAX_TOTAL = 100, 100, 300, 400
MIN_CONFIDENCE = 0.60
POPULAR_PULLS = 1_000_000
RULE_ECOSYSTEMS = ("github-actions", "huggingface")
BACKFILL_SKIP = ("npm_registry", "pypi", "cargo", "maven", "nuget", "rubygems", "go_modules", "hex", "packagist", "pub")
CAMPAIGN_CONFIDENCE = {"high": 0.90, "medium": 0.70, "low": 0.40}
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
V4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
V6 = "^(?=.*:.*:)[0-9A-Fa-f:]{2,39}$"


def is_ip(value: Column) -> Column:
    """A dotted quad without leading zeros, or hexadecimal groups with colons."""
    return F.coalesce(value.rlike(V4) | value.rlike(V6), F.lit(False))


def feed_ip(value: Column) -> Column:
    """Fit for a feed: an address that is none of our own."""
    return is_ip(value) & ~E.blocked_ip(value)


def feed_domain(value: Column) -> Column:
    """Fit for a feed: lower case, no address, with a dot, no separators, a last label of 2 to 24 letters, not blocked.

    That the name is itself a public suffix isn't tested: no list of them is installed.
    """
    shape = (value == F.lower(value)) & ~is_ip(value) & value.contains(".") & ~value.rlike(r"[ \t:/\\@,;=]") & value.rlike(r"\.[a-z]{2,24}$")
    return F.coalesce(shape & ~E.blocked_domain(value), F.lit(False))


def feed_entry(kind: Column, value: Column) -> Column:
    kind = F.lower(kind)
    return F.when(kind == "domain", feed_domain(value)).when(kind == "ip", feed_ip(value)).when(kind == "url", ~F.coalesce(E.blocked_url(value), F.lit(False))).otherwise(F.lit(True))


def anomalous(domains: Column, ips: Column, hashes: Column) -> Column:
    """The circuit breaker: so many indicators speak for a parser's mistake."""
    n = [F.coalesce(c, F.lit(0)) for c in (domains, ips, hashes)]
    return (n[0] > MAX_DOMAINS) | (n[1] > MAX_IPS) | (n[2] > MAX_HASHES) | (n[0] + n[1] + n[2] > MAX_TOTAL)


def cve_quality(has_extension: Column, exploited: Column, public: Column, cvss: Column, actors: Column) -> Column:
    """Records without a CVE extension pass; others if exploited, with a public exploit, of CVSS 9 or more, or with actors."""
    keep = F.coalesce(exploited, F.lit(False)) | F.coalesce(public, F.lit(False)) | F.coalesce(cvss >= 9.0, F.lit(False)) | (F.coalesce(actors, F.lit(0)) > 0)
    return ~F.coalesce(has_extension, F.lit(False)) | keep


def os_package(severity: Column, in_images: Column, has_fix: Column, exploited: Column) -> Column:
    """High or critical, in a popular image (null: no list of images, so no gate), and with a fix or known to be exploited."""
    return F.coalesce(severity.isin("high", "critical"), F.lit(False)) & F.coalesce(in_images, F.lit(True)) & (F.coalesce(has_fix, F.lit(False)) | F.coalesce(exploited, F.lit(False)))


def container_tier(popular: Column, exploited: Column, cvss: Column, public: Column, end_of_life: Column, second: float = 9.0, third: float = 7.0) -> Column:
    """2 for images at their end of life; of popular ones (null: no list, so all are) 1 if exploited, 2 and 3 by CVSS; else 0, which is dropped."""
    cvss = F.coalesce(cvss, F.lit(0.0))
    tier = F.when(~F.coalesce(popular, F.lit(True)), 0).when(F.coalesce(exploited, F.lit(False)), 1).when(cvss >= second, 2).when((cvss >= third) & F.coalesce(public, F.lit(False)), 3).otherwise(0)
    return F.when(F.coalesce(end_of_life, F.lit(False)), 2).otherwise(tier)


def best_confidence(confidences: Column, campaign_confidence: Column) -> Column:
    """The greatest of an incident's indicators; without one above 0 what its campaign's level stands for."""
    best = F.coalesce(F.array_max(confidences), F.lit(0.0))
    return F.when(best > 0, best).otherwise(E.lookup(F.lower(F.coalesce(campaign_confidence, F.lit(""))), CAMPAIGN_CONFIDENCE))


def sure_indicator(confidences: Column) -> Column:
    """Whether one indicator at least is sure enough for rules."""
    return F.coalesce(F.exists(confidences, lambda c: c >= MIN_CONFIDENCE), F.lit(False))


def draft_signal(packages: Column, indicators: Column) -> Column:
    return (F.coalesce(packages, F.lit(0)) > 0) | (F.coalesce(indicators, F.lit(0)) > 0)


def has_own_rules(ecosystems: Column) -> Column:
    return F.coalesce(F.exists(ecosystems, lambda e: e.isin(*RULE_ECOSYSTEMS)), F.lit(False))


def searchable(tier: Column) -> Column:
    """All but containers of tier 4."""
    return F.coalesce(tier != 4, F.lit(True))


def in_backfill(source: Column) -> Column:
    """Sources that a backfill polls again."""
    return ~F.coalesce(source.isin(*BACKFILL_SKIP), F.lit(False))


def fresh(fetched: Column, now: Column, days: int) -> Column:
    """Whether a cached entry is younger than so many days; one without a date isn't."""
    return F.coalesce(F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(fetched.cast("timestamp")) < days * 86400, F.lit(False))
