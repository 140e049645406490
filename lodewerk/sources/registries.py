"""Anomalies in package registries: predicates over landed rows, as (name, ecosystem, reason)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.index import previous_values

# the lists of the reference; "trojan" and "k8s.io/" are ours
NPM_HOOKS = ("preinstall", "postinstall", "prepare")
PYPI_WORDS = ("reverse shell", "backdoor", "exfil", "stealer", "credential harvest", "cryptominer", "keylogger", "ransomware", "trojan")
CRATE_WORDS = ("backdoor", "stealer", "exfil", "ransom", "cryptominer")
CRATE_NAMES = ("tokio", "serde", "rand", "log", "regex", "clap", "hyper", "reqwest", "actix", "axum", "sqlx", "diesel")
RESERVED_PATHS = ("golang.org/", "google.golang.org/", "gopkg.in/go-", "k8s.io/")
MAVEN_GROUPS = ("org.apache.", "com.google.", "org.springframework.", "com.fasterxml.", "io.netty.", "org.slf4j.", "commons-")
ODD_TLDS = ("xyz", "top", "click", "online", "site", "space")
HOOKS = ("pre-install-cmd", "post-install-cmd", "pre-update-cmd", "post-update-cmd", "post-root-package-install")


def found(rows: DataFrame, name: Column, ecosystem: str, reason: Column) -> DataFrame:
    """Rows with a reason; null is none."""
    return rows.select(name.alias("name"), F.lit(ecosystem).alias("ecosystem"), reason.alias("reason")).filter("reason is not null")


def npm(versions: DataFrame) -> DataFrame:
    """(name, version, published, size, scripts): an install hook in the newest version, or one over 500 KiB and three times the one before it."""
    newest = Window.partitionBy("name").orderBy(F.desc("published"), F.desc("version"))
    rows = previous_values(versions, "name", ["published", "version"], "size").withColumn("n", F.row_number().over(newest)).filter("n = 1")
    hook = F.exists(F.array(*map(F.lit, NPM_HOOKS)), lambda h: F.coalesce(F.try_element_at("scripts", h), F.lit("")) != "")
    grown = (F.col("size") > 500 * 1024) & (F.col("size") > 3 * F.col("previous"))
    return found(rows, F.col("name"), "npm", F.when(hook, "install_hook").when(grown, "size_spike"))


def pypi(updates: DataFrame) -> DataFrame:
    """(title, description): every suspicious word of an update."""
    text = F.lower(F.concat_ws(" ", "title", "description"))
    words = F.filter(F.array(*map(F.lit, PYPI_WORDS)), lambda w: F.contains(text, w))
    return found(updates, F.split("title", " ")[0], "pypi", F.when(F.size(words) > 0, F.array_join(words, ",")))


def crates(rows: DataFrame) -> DataFrame:
    """(name) and, where the feed has one, description: the first malicious word; else one or two edits from a well-known crate, the first in order."""
    text = F.lower(F.concat_ws(" ", "name", *(["description"] if "description" in rows.columns else [])))
    word = F.try_element_at(F.filter(F.array(*map(F.lit, CRATE_WORDS)), lambda w: F.contains(text, w)), F.lit(1))
    name = F.lower("name")
    near = F.filter(F.array(*map(F.lit, CRATE_NAMES)), lambda t: (name != t) & (((F.length(t) >= 5) & (F.levenshtein(name, t) <= 2)) | ((F.length(t) >= 3) & (F.levenshtein(name, t) == 1))))
    return found(rows, F.col("name"), "cargo", F.coalesce(F.concat(F.lit("keyword "), word), F.concat(F.lit("near "), F.try_element_at(near, F.lit(1)))))


def maven(rows: DataFrame) -> DataFrame:
    """(group, artifact, version): a digit in an artifact of a well-known group with a short version."""
    odd = F.col("group").rlike("^(" + "|".join(g.replace(".", r"\.") for g in MAVEN_GROUPS) + ")") & F.col("artifact").rlike("[0-9]") & (F.length("version") < 3)
    return found(rows, F.concat_ws(":", "group", "artifact"), "maven", F.when(odd, "namespace"))


def nuget(rows: DataFrame) -> DataFrame:
    """(name, entries): the first file that runs at build time."""
    hook = F.try_element_at(F.filter("entries", lambda e: F.lower(e).rlike(r"\.(targets|props)$")), F.lit(1))
    return found(rows, F.col("name"), "nuget", F.concat(F.lit("build hook "), hook))


def rubygems(rows: DataFrame) -> DataFrame:
    """(name, executables)"""
    return found(rows, F.col("name"), "rubygems", F.when(F.size("executables") > 0, "executables"))


def go(rows: DataFrame) -> DataFrame:
    """(path): under a reserved path."""
    return found(rows, F.col("path"), "go", F.when(F.col("path").rlike("^(" + "|".join(p.replace(".", r"\.") for p in RESERVED_PATHS) + ")"), "reserved"))


def hex_pm(rows: DataFrame) -> DataFrame:
    """(name, releases newest first with a publisher): the two newest have different ones."""
    a, b = F.try_element_at("releases", F.lit(1))["publisher"], F.try_element_at("releases", F.lit(2))["publisher"]
    return found(rows, F.col("name"), "hex", F.when(a != b, F.concat(b, F.lit(" to "), a)))


def packagist(rows: DataFrame) -> DataFrame:
    """(name, composer): life-cycle hooks."""
    return found(rows, F.col("name"), "composer", F.when(F.lower("composer").rlike("|".join(HOOKS)), "hook"))


def pub(rows: DataFrame) -> DataFrame:
    """(name, publisher): an address under an unusual top-level domain."""
    return found(rows, F.col("name"), "pub", F.when(F.lower("publisher").rlike(r"\.(" + "|".join(ODD_TLDS) + ")$"), "publisher"))


def changed_tags(current: DataFrame, stored: DataFrame) -> DataFrame:
    """(name, tag, sha) against the stored ones: a tag that moved; one that is new is only recorded."""
    old = stored.select("name", "tag", F.col("sha").alias("old"))
    return current.join(old, ["name", "tag"]).filter("sha <> old").select("name", "tag", "old", "sha", F.when(F.col("name").startswith("actions/"), "critical").otherwise("high").alias("severity"))
