"""Text functions of records: slugs, cuts, names, descriptions, keywords, indicators in code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import exprs as E

SUPPLY_WORDS = ("npm", "pypi", "cargo", "nuget", "rubygems", "packagist", "supply chain", "malicious package", "compromised package", "typosquat", "dependency confusion", "poisoned package", "malicious npm", "malicious pypi", "open source attack", "preinstall script", "postinstall script")
ECOSYSTEM_WORDS = {
    "npm": ("npm", "node_modules", "package.json", "yarn", "pnpm"),
    "pypi": ("pypi", "pip install", "setup.py", "pyproject.toml"),
    "cargo": ("crates.io", "cargo.toml", "cargo add"),
    "maven": ("maven", "pom.xml", "mvn", "groupid", "artifactid"),
    "nuget": ("nuget", "dotnet add package", ".csproj", "nuspec"),
    "rubygems": ("rubygems", "gem install", "gemfile", ".gemspec"),
    "go": ("go.mod", "go get", "pkg.go.dev", "golang"),
    "hex": ("hex.pm", "mix.exs", "elixir", "erlang"),
    "packagist": ("packagist", "composer.json", "composer require"),
    "pub": ("pub.dev", "pubspec.yaml", "flutter pub"),
}
REFERENCE_TIERS = (
    ("cisa.gov", "nvd.nist.gov", "osv.dev"),
    ("aikido.dev", "stepsecurity.io", "wiz.io", "socket.dev", "bleepingcomputer.com", "thehackernews.com", "securelist.com", "sentinelone.com", "unit42.paloalto", "mandiant.com", "crowdstrike.com"),
    ("github.com/advisories", "github.com/security/advisories"),
    ("github.com",),
)
MAX_RULE_REFERENCES = 15
ACTOR_TYPES = (
    ("nation-state", ("nation-state", "state-sponsored", "government", "military intelligence")),
    ("criminal", ("financially motivated", "ransomware", "criminal", "cybercrime")),
    ("hacktivist", ("hacktivist", "ideology")),
)


def any_of(text: Column, words) -> Column:
    """Whether one of the words stands in the text, in whatever case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def tag_slug(text: Column) -> Column:
    """Runs of other characters become one dash, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def title_slug(text: Column, most: int = 40) -> Column:
    return F.regexp_replace(F.substring(tag_slug(text), 1, most), "-+$", "")


def plain_slug(text: Column) -> Column:
    """Each other byte becomes a dash of its own; dashes stay."""
    wide = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")  # a character for each byte
    return F.regexp_replace(F.translate(wide, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9-]", "-")


def id_slug(text: Column) -> Column:
    """Each other character becomes a dash, runs of dashes one, none at the ends."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(low, "[^a-z0-9-]", "-"), "-{2,}", "-"), "^-+|-+$", "")


def truncate(text: Column, most: int, tail: str = "") -> Column:
    """The first ``most`` bytes, but whole characters only, and ``tail`` if something was cut off."""
    head = F.make_valid_utf8(F.substring(F.encode(text, "UTF-8"), 1, most).cast("string"))
    return F.when(F.octet_length(text) > most, F.concat(F.regexp_replace(head, "\ufffd+$", ""), F.lit(tail))).otherwise(text)


def post_id(source: Column, url: Column, title: Column) -> Column:
    """A post's id: source, slug of the title, the beginning of the address's digest."""
    slug = title_slug(title)
    return F.concat_ws("-", source, F.when(slug != "", slug), F.substring(F.sha2(url, 256), 1, 8))


def draft_id(module: Column, source: Column, title: Column) -> Column:
    return truncate(F.concat(module, F.lit("-draft-"), id_slug(source), F.lit("-"), id_slug(title)), 80)


def draft_description(title: Column, description: Column) -> Column:
    """The description if there is one of fewer than 300 bytes, else the title."""
    return F.when((description != "") & (F.octet_length(description) < 300), description).otherwise(title)


def actor_type(description: Column) -> Column:
    out = F.lit("unknown")
    for label, words in reversed(ACTOR_TYPES):
        out = F.when(any_of(description, words), label).otherwise(out)
    return out


def score_severity(score: Column) -> Column:
    return F.when(score >= 4, "critical").when(score >= 3, "high").when(score >= 2, "medium").otherwise("low")


def reference_tier(ref: Column) -> Column:
    out = F.lit(len(REFERENCE_TIERS))
    for tier in reversed(range(len(REFERENCE_TIERS))):
        hit = F.lit(False)
        for part in REFERENCE_TIERS[tier]:
            hit = hit | ref.contains(part)
        out = F.when(hit, tier).otherwise(out)
    return out


def best_references(refs: Column, most: int = MAX_RULE_REFERENCES) -> Column:
    """All references in their order if there are ``most`` at most, else the first of them by tier."""
    ranked = F.array_sort(F.transform(refs, lambda r, i: F.struct(reference_tier(r).alias("tier"), i.alias("nth"), r.alias("ref"))))
    return F.when(F.size(refs) <= most, refs).otherwise(F.transform(F.slice(ranked, 1, most), lambda x: x["ref"]))


def yaml_quoted(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit("''"))


def condition(names: list[tuple[str, Column]], rest: str = "selection") -> Column:
    """The names of those selections that have values, joined by or."""
    return F.coalesce(F.nullif(F.concat_ws(" or ", *(F.when(F.coalesce(F.size(c), F.lit(0)) > 0, name) for name, c in names)), F.lit("")), F.lit(rest))


def rich_description(actor: Column, campaign: Column, description: Column, start: Column, sources: Column, confidence: Column) -> Column:
    """Who, what, since when and how sure, a line for each; what isn't known is left out."""
    actor, campaign = F.coalesce(actor, F.lit("")), F.coalesce(campaign, F.lit(""))
    who = F.when((actor != "") & (campaign != ""), F.concat(F.lit("Associated with "), actor, F.lit(" ("), campaign, F.lit(" campaign).")))
    who = who.when(actor != "", F.concat(F.lit("Associated with "), actor, F.lit("."))).when(campaign != "", F.concat(F.lit("Associated with "), campaign, F.lit(" campaign.")))
    clean = F.trim(F.regexp_replace(F.regexp_replace(description, "[\u0000-\u0008\u000b\u000c\u000e-\u001f]", ""), r"\s+", " "))
    what = F.when((F.octet_length(description) > 10) & ~description.startswith("Incident: "), clean)
    since = F.concat(F.lit("First observed: "), F.date_format(E.rfc3339(start), "yyyy-MM-dd"), F.lit("."))
    sure = F.when((confidence > 0) & (F.size(sources) > 0), F.concat(F.lit("Confidence: "), F.bround(confidence * 100, 0).cast("int").cast("string"), F.lit("% ("), F.array_join(sources, ", "), F.lit(").")))
    return F.concat_ws("\n  ", who, what, since, sure)


def rule_name(title: Column, rule_id: Column) -> Column:
    """An identifier: letters and digits in lower case, runs of others one underscore, and the end of the rule's id."""
    name = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"[^\p{L}\p{Nd}]+", "_"), "^_+|_+$", "")
    return F.concat_ws("_", F.when(name == "", "rule").otherwise(name), F.substring(F.replace(rule_id, F.lit("-"), F.lit("")), -8, 8))


def file_name(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9_-]", "_")


def embedded_id(text: Column) -> Column:
    """The word after the first "Incident: "; empty without one."""
    return F.coalesce(F.regexp_extract(text, r"Incident: (\S+)", 1), F.lit(""))


def embedded_category(text: Column) -> Column:
    return F.coalesce(F.regexp_extract(text, r"(?m)^  category:\s*(\S+)", 1), F.lit(""))


def campaign_name(text: Column, labels: str = "campaign|operation|cluster|actor|group") -> Column:
    """The name of at least four characters that follows a label."""
    return F.trim(F.coalesce(F.regexp_extract(text, rf"(?i)(?:{labels})\s*:?\s*([A-Z][A-Za-z0-9][A-Za-z0-9 \-]{{2,38}})", 1), F.lit("")))


def raw_address(url: Column) -> Column:
    """The raw file of an address in a code host's blob view; empty for others."""
    return F.when(url.rlike("^https://github[.]com/[^/]+/[^/]+/blob/"), F.regexp_replace(url, "^https://github[.]com/([^/]+/[^/]+)/blob/", "https://raw.githubusercontent.com/$1/")).otherwise("")


def one_slash(url: Column) -> Column:
    """http:/x becomes http://x."""
    return F.regexp_replace(url, "^(https?):/([^/])", "$1://$2")


def network_kind(raw: Column) -> Column:
    """(type, value) of a network indicator once its brackets and hxxp are undone; null if it is none."""
    text = F.trim(E.undefang(raw))
    ip = F.regexp_extract(text, r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", 0)
    url = E.normalize_ioc(F.lit("url"), text)
    kind = F.when(text.rlike("^https?://"), F.when(url.isNotNull(), F.struct(F.lit("url").alias("type"), url.alias("value"))))
    return kind.when(ip != "", F.struct(F.lit("ip").alias("type"), ip.alias("value"))).when(text.contains(".") & ~text.contains(" "), F.struct(F.lit("domain").alias("type"), text.alias("value")))


_SET = r"""\s*(?:=>|=)\s*['"]"""
CODE_PATTERNS = (
    ("url_pattern", r"""(?i)(?:'uri'|"uri"|'path'|"path"|uri|path)""" + _SET + r"""(/[^'"]{3,})['"]""", 0.8),
    ("url_pattern", r"""['"](/[\w\-./%_?=&+]{5,})['"]""", 0.6),
    ("user_agent", r"""(?i)(?:'User-Agent'|"User-Agent"|user_agent)\s*(?:=>|=|:)\s*['"]([^'"\n]{5,})['"]""", 0.8),
    ("request_body_pattern", r"""(?i)(?:'data'|"data"|'body'|"body"|data|body)""" + _SET + r"""([^'"\n]{5,})['"]""", 0.7),
    ("request_body_pattern", r"""(?i)\b((?:cmd|exec|shell|payload|command|eval|system)=[^\s&'"]{3,})""", 0.5),
)
FILE_SYSTEM = "^/(usr|etc|var|opt|home|root|tmp|bin|lib)/"


def web_path(path: Column) -> Column:
    """A path of a web server rather than of a file system."""
    return ~path.rlike("(?i)" + FILE_SYSTEM) & (F.octet_length(path) >= 5) & (path.rlike("[.?]") | path.rlike("(?i)admin|api|upload|shell|cmd|exec"))


def _trait(kind: str, confidence: float):
    return lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value"), F.lit(confidence).alias("confidence"))


def code_indicators(code: Column) -> Column:
    """(type, value, confidence) of HTTP traits in exploit code, in the order of the patterns; a repeated (type, value) keeps its first."""
    parts = []
    for kind, pattern, confidence in CODE_PATTERNS:
        found = F.transform(F.regexp_extract_all(code, F.lit(pattern), F.lit(1)), lambda v: F.trim(v))
        found = F.filter(found, web_path if pattern is CODE_PATTERNS[1][1] else (lambda v: v != ""))
        parts.append(F.transform(found, _trait(kind, confidence)))
    every = F.concat(*parts)
    return F.filter(every, lambda x, i: ~F.exists(F.slice(every, 1, i), lambda y: (y["type"] == x["type"]) & (y["value"] == x["value"])))


def stix_confidence(confidence: Column) -> Column:
    """0 to 100, cut off; 0 if there is none."""
    return F.least((F.coalesce(confidence, F.lit(0.0)) * 100 + 1e-9).cast("int"), F.lit(100))


def technique_address(technique: Column) -> Column:
    return F.concat(F.lit("https://attack.mitre.org/techniques/"), F.replace(technique, F.lit("."), F.lit("/")))


def title_parts(title: Column) -> Column:
    """(name, version) of a title "name version ..."."""
    parts = F.split(F.trim(title), r"\s+")
    return F.struct(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")).alias("name"), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("version"))
