"""Checks of what was written, and repairs of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import gates as G

DEFAULT_ATTACK = {"supply": "supply-chain", "malware": "malware", "ransomware": "ransomware", "cve": "vulnerability", "container": "vulnerability", "os-packages": "vulnerability"}
REQUIRED = ("id", "attack_type", "severity", "description")
IDENTIFIER = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def violations(records: DataFrame) -> DataFrame:
    """(id, problem): missing fields, neither package nor reference, more indicators than a record can have."""
    checks = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(f"no {c}")) for c in REQUIRED]
    checks.append(F.when((F.col("packages") == 0) & (F.col("refs") == 0), F.lit("no package, no reference")))
    d, i, h = (F.col(c) for c in ("domains", "ips", "hashes"))
    checks.append(F.when(d > G.MAX_DOMAINS, "domains").when(i > G.MAX_IPS, "ips").when(h > G.MAX_HASHES, "hashes").when(d + i + h > G.MAX_TOTAL, "indicators"))
    return records.select("id", F.explode(F.array_compact(F.array(*checks))).alias("problem"))


def scrub(indicators: DataFrame) -> DataFrame:
    """(id, type, value, cleaned): indicators as the normaliser leaves them; null where it rejects them."""
    return indicators.withColumn("cleaned", E.normalize_ioc(F.col("type"), F.col("value")))


def empty_records(records: DataFrame, packages: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Records without a package, a valid indicator and an extension; a CVE alone is reason enough to keep one."""
    full = packages.select("id").unionByName(cleaned.filter("cleaned is not null").select("id")).distinct()
    return records.filter(~F.coalesce(F.col("has_extension"), F.lit(False))).join(full, "id", "left_anti")


def removals(cleaned: DataFrame) -> DataFrame:
    """By type how many indicators were rejected and changed."""
    gone = F.col("cleaned").isNull()
    return cleaned.groupBy("type").agg(F.count_if(gone).alias("removed"), F.count_if(~gone & (F.col("cleaned") != F.col("value"))).alias("changed"))


def migrate_indicators(indicators: DataFrame) -> DataFrame:
    """(id, type, value): addresses filed as domains are promoted, dots at the end and private addresses go, addresses of pages need a scheme; once each."""
    bare = F.rtrim(F.col("value"), F.lit("."))
    v4 = bare.rlike(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$")
    kind = F.when((F.col("type") == "domain") & v4, "ip").otherwise(F.col("type"))
    value = F.when(F.col("type").isin("domain", "ip"), bare).otherwise(F.col("value"))
    keep = F.when(kind == "ip", ~E.blocked_ip(bare)).when(F.col("type") == "url", F.col("value").rlike("^https?://")).otherwise(F.lit(True))
    return indicators.filter(F.coalesce(keep, F.lit(False))).select("id", kind.alias("type"), value.alias("value")).distinct()


def default_attack(records: DataFrame) -> DataFrame:
    table = F.create_map(*[F.lit(x) for item in DEFAULT_ATTACK.items() for x in item])
    return records.withColumn("attack_type", F.coalesce(F.nullif("attack_type", F.lit("")), F.try_element_at(table, F.col("module")), F.lit("")))


def migrate_packages(packages: DataFrame) -> DataFrame:
    """Packages but those whose name is none or that have no ecosystem."""
    return packages.filter(~E.false_package(F.col("name")) & (F.coalesce("ecosystem", F.lit("")) != ""))


def cross_checks(modules: DataFrame) -> DataFrame:
    """(module, problem) of (module, records, listed, index_missing, lookup_missing, rules, feed): what contradicts what."""
    n, listed = F.col("records"), F.col("listed")
    checks = [
        F.when((n == 0) & (F.col("rules") > 0), F.lit("orphan rules")),
        F.when((n == 0) & (F.col("feed") > 0), F.lit("orphan feed")),
        F.when((n > 0) & (listed > 0) & (F.abs(listed - n) * 100 > listed), F.lit("drift")),
        F.when(F.col("index_missing") & (n > 0), F.lit("no index")),
        F.when((F.col("module") == "supply") & F.col("lookup_missing") & (n > 0), F.lit("no lookup")),
        F.when((n > 0) & (F.col("rules") > 100 * n), F.lit("too many rules")),
    ]
    return modules.select("module", F.explode(F.array_compact(F.array(*checks))).alias("problem"))


def report(**checks: DataFrame) -> DataFrame:
    """(check, n): how many rows each check found."""
    out = None
    for name, found in checks.items():
        rows = found.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
        out = rows if out is None else out.unionByName(rows)
    return out


def lint_rules(rules: DataFrame) -> DataFrame:
    """(rule_id, problem): missing keys, ids that are no UUID, unknown status, no condition."""
    checks = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(f"no {c}")) for c in ("title", "rule_id", "status", "level", "logsource", "condition")]
    checks.append(F.when((F.col("rule_id") != "") & ~F.col("rule_id").rlike(IDENTIFIER), F.lit("bad id")))
    checks.append(F.when((F.col("status") != "") & ~F.col("status").isin("stable", "test", "experimental", "deprecated", "unsupported"), F.lit("bad status")))
    return rules.select("rule_id", F.explode(F.array_compact(F.array(*checks))).alias("problem"))
