"""Column builders: every rule on a single value, inside whole-stage code generation where Spark has it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def lookup(key: Column, table: dict[str, float], default: float = 0.0) -> Column:
    """A literal map; keys that aren't in it give the default."""
    pairs = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def confidence(sources: Column) -> Column:
    """Highest weight plus 0.08 for every further source (0.20 at most), 0.98 at most; 0.30 without sources. Repeated sources count."""
    weights = F.create_map(*[F.lit(x) for item in K.SOURCE_WEIGHTS.items() for x in item])
    best = F.aggregate(sources, F.lit(0.0), lambda top, s: F.greatest(top, F.coalesce(F.try_element_at(weights, s), F.lit(0.0))))
    bonus = F.least((F.size(sources) - 1) * F.lit(0.08), F.lit(0.20))
    return F.when(F.coalesce(F.size(sources), F.lit(0)) <= 0, F.lit(0.30)).otherwise(F.least(best + bonus, F.lit(0.98)))


def decay(score: Column, first_seen: Column, now: Column) -> Column:
    """A cap by age; rows without a date keep their score."""
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(first_seen.cast("timestamp"))
    out = score
    for days, cap in reversed(K.DECAY):
        out = F.when(age > days * 86400, F.least(score, F.lit(cap))).otherwise(out)
    return out


def _bins(value: Column, bins: tuple, rest: str) -> Column:
    out = F.lit(rest)
    for least, label in reversed(bins):
        out = F.when(value >= least, F.lit(label)).otherwise(out)
    return out


def status(score: Column) -> Column:
    return _bins(score, K.STATUS, "deprecated")


def impact_rating(weekly: Column) -> Column:
    return _bins(weekly, K.IMPACT, "negligible")


def severity_rank(severity: Column) -> Column:
    """4 for critical to 1 for low, 0 for anything else."""
    rank = F.lit(0)
    for n, name in enumerate(K.SEVERITIES, 1):
        rank = F.when(F.lower(severity) == name, F.lit(n)).otherwise(rank)
    return rank


def severity_label(rank: Column) -> Column:
    """Rank 0 is shown as medium."""
    return F.coalesce(F.try_element_at(F.array(*map(F.lit, K.SEVERITIES)), F.when(rank > 0, rank)), F.lit("medium"))


def cvss_severity(score: Column) -> Column:
    return _bins(score, ((9.0, "critical"), (7.0, "high"), (4.0, "medium")), "low")


def slug(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits become one dash, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-|-$", "")


def shard_key(name: Column) -> Column:
    head = F.regexp_extract(F.lower(name), "^[a-z0-9]+", 0)
    return F.when(F.coalesce(head, F.lit("")) == "", F.lit("misc")).otherwise(head)


def rfc3339(text: Column) -> Column:
    """The instant of a strict time stamp with its zone; null for anything else."""
    ok = text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$")
    return F.when(ok, F.try_to_timestamp(text))


def content_hash(*parts: Column) -> Column:
    """SHA-256 of the parts, line by line; lists have to be sorted and joined before."""
    return F.sha2(F.concat_ws("\n", *parts), 256)


URL_SPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column) -> Column:
    """The name-based UUID (version 5) in the URL name space; empty without a name.

    The hash is named twice, no oftener: ids are made of ids, and expressions
    grow with a power of how deep they are nested.
    """
    h = F.sha1(F.concat(F.unhex(F.lit(URL_SPACE)), F.encode(name, "UTF-8")))
    variant = F.lit("89ab" * 4).substr(F.position(F.substring(h, 17, 1), F.lit("0123456789abcdef")), F.lit(1))
    out = F.overlay(F.overlay(F.substring(h, 1, 32), F.lit("-5"), 13, 1), F.lit("-"), 9, 0)
    return F.coalesce(F.overlay(F.overlay(out, F.concat(F.lit("-"), variant), 19, 1), F.lit("-"), 24, 0), F.lit(""))


def sid(uuid: Column) -> Column:
    """A rule number between 1,000,000 and 9,999,999 from a UUID's first 32 bits."""
    return F.conv(F.substring(uuid, 1, 8), 16, 10).cast("bigint") % 9_000_000 + 1_000_000


def blocked_ip(ip: Column) -> Column:
    """Private, loop-back and link-local networks and public resolvers, as one pattern for each version."""
    v6 = F.lower(ip)
    blocked = ip.isin(K.RESOLVERS) | ip.rlike(K.PRIVATE_V4) | (v6.rlike("^[0-9a-f:]+$") & v6.rlike(K.PRIVATE_V6))
    return F.coalesce(blocked, F.lit(False))


def blocked_domain(domain: Column) -> Column:
    name = F.lower(domain)
    blocked = blocked_ip(domain) | ~name.contains(".") | F.substring_index(name, ".", -1).isin(K.RESERVED_TLDS + K.FILE_EXTENSIONS) | name.isin(K.BENIGN_DOMAINS)
    return F.coalesce(blocked | name.rlike(r"\.(" + "|".join(s.replace(".", r"\.") for s in K.BENIGN_SUFFIXES) + ")$"), F.lit(False))


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)


def blocked_url(url: Column) -> Column:
    host = F.regexp_replace(url_host(url), r"[\[\]]", "")
    return (F.coalesce(host, F.lit("")) != "") & (blocked_ip(host) | blocked_domain(host))


def normalize_ioc(kind: Column, raw: Column) -> Column:
    """The clean value of an indicator; null if it is to be dropped."""
    text = F.trim(raw)
    ip = F.regexp_extract(text, r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", 0)
    url = F.regexp_replace(text, r"\s+.*$", "")
    out = F.when(kind == "ip", F.when((ip != "") & ~blocked_ip(ip), ip))
    out = out.when(kind == "url", F.when(url.rlike("^https?://") & ~blocked_url(url), url))
    out = out.when(kind == "domain", F.when(~text.rlike("[ \t·:]") & ~blocked_domain(text), text))
    for name, empty in K.EMPTY_HASHES.items():
        out = out.when(kind == name, F.when(text != empty, text))
    return F.when(text != "", out.otherwise(text))


def undefang(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\[\.\]|\(\.\)|\{\.\}", "."), "(?i)hxxps://", "https://"), "(?i)hxxp://", "http://")


def false_package(name: Column) -> Column:
    return F.coalesce((F.octet_length(name) > 100) | (name == "") | name.rlike(r"\s") | name.rlike("[.,;!?]$") | F.lower(name).isin(K.NO_PACKAGES), F.lit(True))


def fold(name: Column) -> Column:
    """Look-alike characters as the ASCII letters they imitate, lower case."""
    return F.translate(F.lower(name), *K.HOMOGLYPHS)


def strip_scope(name: Column) -> Column:
    return F.regexp_replace(name, "^@[^/]*/", "")


def is_addition(a: Column, b: Column) -> Column:
    out = F.lit(False)
    for s in "-_.":
        for x, y in ((a, b), (b, a)):
            out = out | x.startswith(F.concat(y, F.lit(s))) | x.endswith(F.concat(F.lit(s), y))
    return out


def similarity(a: Column, b: Column) -> Column:
    """(score, technique) of lower-case names a and b; score 0 if they aren't alike."""
    d, longest = F.levenshtein(a, b), F.greatest(F.octet_length(a), F.octet_length(b))
    near = ((F.octet_length(b) >= 5) & (d <= 2)) | ((F.octet_length(b) >= 4) & (d == 1))
    apart = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda x: x))
    kind = F.when((d == 1) & (F.length(a) != F.length(b)), "omission").when((d == 2) & (F.length(a) == F.length(b)) & (apart == 2), "swap").otherwise("substitution")

    def pair(score: Column, technique: Column) -> Column:
        return F.struct(score.cast("double").alias("score"), technique.alias("technique"))

    scoped = ((strip_scope(a) != a) | (strip_scope(b) != b)) & (strip_scope(a) == strip_scope(b))
    out = F.when(fold(a) == fold(b), pair(F.lit(0.99), F.lit("homoglyph"))).when(scoped, pair(F.lit(0.95), F.lit("prefix_scope"))).when(is_addition(a, b), pair(F.lit(0.85), F.lit("addition")))
    return out.when((longest >= 4) & near, pair(F.round(1 - d / longest, 12), kind)).otherwise(pair(F.lit(0.0), F.lit("")))


def cvss3_base(text: Column) -> Column:
    """A number as it is, else the base score of a version 3 vector, else 0; without the factor 1.08 for a changed scope."""
    metrics = F.str_to_map(F.regexp_replace(text, "^[^/]*/", ""), F.lit("/"), F.lit(":"))

    def of(metric: str, table: str) -> Column:
        got = F.try_element_at(metrics, F.lit(metric))
        return F.try_element_at(F.create_map(*[F.lit(x) for item in K.CVSS[table].items() for x in item]), got)

    changed = F.coalesce(F.try_element_at(metrics, F.lit("S")) == "C", F.lit(False))
    pr = F.when(changed, of("PR", "PR changed")).otherwise(of("PR", "PR"))
    iss = 1 - (1 - of("C", "CIA")) * (1 - of("I", "CIA")) * (1 - of("A", "CIA"))
    impact = F.when(changed, 7.52 * (iss - 0.029) - 3.25 * F.pow(iss - 0.02, F.lit(15))).otherwise(6.42 * iss)
    base = F.least(impact + 8.22 * of("AV", "AV") * of("AC", "AC") * pr * of("UI", "UI"), F.lit(10.0))
    vector = F.when(text.startswith("CVSS:") & (impact > 0), F.ceil(base * 10) / 10)
    return F.coalesce(F.trim(text).try_cast("double"), vector, F.lit(0.0))


def flatten_space(text: Column) -> Column:
    """Latin-1 read as UTF-8 is repaired if that loses nothing; control characters go, white space becomes one blank."""
    again = F.make_valid_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    fixed = F.when(text.rlike("[\u00c2-\u00f4][\u0080-\u00bf]") & ~text.rlike("[^\u0001-\u00ff]") & ~again.contains("\ufffd"), again).otherwise(text)
    return F.trim(F.regexp_replace(F.regexp_replace(fixed, "[\u0080-\u009f]", ""), r"\s+", " "))
