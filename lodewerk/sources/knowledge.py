"""Landed knowledge bases and dimensions: OS packages, exploits, a commercial feed, ends of life, popular images and packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import words as W
from ..operators.index import keep_first
from . import landed as L

REPOSITORIES = {"red hat": "redhat/ubi9", "redhat": "redhat/ubi9", "oracle linux": "oraclelinux", "rocky linux": "rockylinux", "alma": "almalinux", "amazon linux": "amazonlinux"}
MAX_IMAGES = 50
TOPIC_SCHEMA = "name string, document string, score double, created string"
VULN_SCHEMA = "id string, title string, packageName string, version string, severity string, publicationTime string, references array<struct<url:string>>"
#: weekly downloads from what a registry publishes
WEEKLY = {"npm": "downloads", "pypi": "last_week", "cargo": "recent_downloads div 12", "nuget": "total div 52", "rubygems": "total div 52", "hex": "recent", "packagist": "monthly div 4", "pub": "cast(score * 10000000 as bigint)", "github-actions": "10000000 div rank", "huggingface": "monthly div 4"}


def malicious_packages(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """A tree of advisories, a file each, however deep."""
    return L.osv(spark, path, since)


def enrich_packages(packages: DataFrame, advisories: DataFrame) -> DataFrame:
    """Advisories (see ``landed``) of the distinct packages (ecosystem, name), each once."""
    wanted = packages.select(F.lower("ecosystem").alias("_e"), F.col("name").alias("_n")).distinct()
    named = advisories.withColumn("_p", F.explode("packages")).withColumn("_e", F.lower("_p.ecosystem")).withColumn("_n", F.col("_p.name"))
    ids = named.join(wanted, ["_e", "_n"], "left_semi").select("id").distinct()
    return keep_first(advisories.join(ids, "id", "left_semi"), ["id"], ["published"])


def family(bucket: Column) -> Column:
    """(family, version) of "Name 1.2"; a last word that doesn't begin with a digit belongs to the name."""
    tail = F.regexp_extract(bucket, r" (\d\S*)$", 1)
    return F.struct(F.lower(F.when(tail != "", F.regexp_replace(bucket, r" \d\S*$", "")).otherwise(bucket)).alias("family"), tail.alias("version"))


def repository(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in REPOSITORIES.items() for x in item])
    return F.coalesce(F.try_element_at(table, name), name)


def os_packages(affected: DataFrame, meta: DataFrame, since: str | None = None) -> DataFrame:
    """By CVE of (bucket, package, cve) with what is known of it (cve, description, severity, last_modified, cvss3, cvss2): its images as sorted "repository:tag", 50 at most, and all tags by repository."""
    parts = affected.select(F.upper("cve").alias("cve"), family(F.col("bucket")).alias("f")).select("cve", repository(F.col("f.family")).alias("repository"), F.col("f.version").alias("tag")).distinct()
    tags = parts.groupBy("cve", "repository").agg(F.array_sort(F.collect_set("tag")).alias("tags"))  # a family's releases
    images = tags.groupBy("cve").agg(F.array_sort(F.collect_list(F.struct("repository", "tags"))).alias("images"))  # a row for each family
    rows = images.join(meta.withColumn("cve", F.upper("cve")), "cve", "left")
    stamp = E.rfc3339(F.col("last_modified"))
    pairs = F.flatten(F.transform("images", lambda i: F.transform(i["tags"], lambda t: F.concat_ws(":", i["repository"], t))))
    kept = rows if since is None else rows.filter(stamp.isNull() | (stamp >= F.lit(since).cast("timestamp")))
    return kept.select(F.concat(F.lit("trivy-"), F.lower(F.replace(F.col("cve"), F.lit("-"), F.lit("")))).alias("id"), "cve", "description", "severity", F.coalesce("cvss3", "cvss2", F.lit(0.0)).alias("cvss"), stamp.alias("published"), "images", F.slice(pairs, 1, MAX_IMAGES).alias("file_names"))


def cycle_of(version: Column) -> Column:
    """The first two numbers of a version."""
    return F.regexp_extract(version, r"^([^.]*(?:\.[^.]*)?)", 1)


def at_end_of_life(rows: DataFrame, cycles: DataFrame, now: Column) -> DataFrame:
    """Rows (product, version) with ``ended`` and ``end``: whether the cycle of the version has ended, and when; unknown ones haven't."""
    dim = cycles.select("product", F.col("cycle").alias("_cycle"), F.when(~F.col("eol").isin("", "false"), F.col("eol")).alias("end")).dropDuplicates(["product", "_cycle"])
    joined = rows.withColumn("_cycle", cycle_of(F.col("version"))).join(dim, ["product", "_cycle"], "left").drop("_cycle")
    day = F.try_to_timestamp("end", F.lit("yyyy-MM-dd"))
    return joined.withColumn("ended", F.coalesce(now.cast("timestamp") > day, F.lit(False))).withColumn("end", F.when(day.isNotNull(), F.col("end")).otherwise(""))


def exploit_topics(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Topics of an exploit knowledge base as CVE rows; a score above 0 stands for a public exploit."""
    rows = spark.read.schema(TOPIC_SCHEMA).json(path)
    return L.shape(rows.filter(L._since(E.rfc3339(F.col("created")), since)), id=F.concat(F.lit("attackerkb-"), W.plain_slug(F.col("name"))), source=F.lit("attackerkb"), attack_type=F.lit("vulnerability"), severity=W.score_severity(F.col("score")), description=F.col("document"), published=E.rfc3339(F.col("created")), cve_id=F.col("name"), exploited=F.col("score") > 0)


def commercial(spark: SparkSession, path: str, since: str | None = None, ecosystem: str = "npm") -> DataFrame:
    """A commercial feed of one ecosystem."""
    rows = spark.read.schema(VULN_SCHEMA).json(path)
    stamp = E.rfc3339(F.col("publicationTime"))
    package = F.struct(F.col("packageName").alias("name"), F.lit("go" if ecosystem == "golang" else ecosystem).alias("ecosystem"), F.array("version").alias("affected_versions"))
    severity = F.when(F.col("severity").isin("critical", "high", "medium"), F.col("severity")).otherwise("low")
    return L.shape(rows.filter(L._since(stamp, since)), id=F.concat(F.lit("snyk-"), W.plain_slug(F.col("id"))), source=F.lit("snyk"), attack_type=F.lit("vulnerability"), severity=severity, description=F.col("title"), published=stamp, packages=F.array(package), references=F.filter(F.col("references.url"), lambda u: u != ""))


def popular_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("repository string, weekly_pulls bigint").json(path).groupBy("repository").agg(F.max("weekly_pulls").alias("weekly_pulls"))


def popular_packages(rows: DataFrame, ecosystem: str, n: int = 1000) -> DataFrame:
    """(ecosystem, name, weekly, impact) of an ecosystem's first n packages by estimated weekly downloads; ecosystems without numbers have none."""
    if ecosystem not in WEEKLY:
        return rows.select(F.lit(ecosystem).alias("ecosystem"), "name", F.lit(0).cast("bigint").alias("weekly"), F.lit("").alias("impact")).limit(0)
    weekly = F.coalesce(F.expr(WEEKLY[ecosystem]), F.lit(0)).cast("bigint")
    return rows.select(F.lit(ecosystem).alias("ecosystem"), "name", weekly.alias("weekly")).orderBy(F.desc("weekly"), "name").limit(n).withColumn("impact", E.impact_rating(F.col("weekly")))


L.READERS.update({"ossf": malicious_packages, "attackerkb": exploit_topics, "snyk": commercial})
