"""Feeds that were landed as files, as incidents with one schema.

Every reader takes (spark, path, since) and gives ``COLUMNS``; rows that don't
parse are skipped, an empty ``since`` keeps all.  Schemas are given, nothing is
inferred, so only the fields that are named are parsed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E

PACKAGE = "struct<name:string,ecosystem:string,affected_versions:array<string>>"
IOC = "struct<type:string,value:string,confidence:double>"
COLUMNS = {
    "id": "string",
    "source": "string",
    "attack_type": "string",
    "severity": "string",
    "description": "string",
    "published": "timestamp",
    "packages": f"array<{PACKAGE}>",
    "references": "array<string>",
    "iocs": f"array<{IOC}>",
    "campaign": "string",
    "cve_id": "string",
    "cvss": "double",
    "exploited": "boolean",
}
OSV_SCHEMA = "id string, modified string, published string, aliases array<string>, summary string, details string, affected array<struct<package:struct<name:string,ecosystem:string>,versions:array<string>>>, severity array<struct<type:string,score:string>>, database_specific struct<severity:string>, references array<struct<url:string>>"
GHSA_SCHEMA = "ghsa_id string, cve_id string, summary string, severity string, published_at string, updated_at string, references array<string>, vulnerabilities array<struct<package:struct<ecosystem:string,name:string>,vulnerable_version_range:string>>"
KEV_SCHEMA = "vulnerabilities array<struct<cveID:string,vendorProject:string,product:string,vulnerabilityName:string,dateAdded:string,shortDescription:string,knownRansomwareCampaignUse:string,notes:string>>"
NVD_SCHEMA = "vulnerabilities array<struct<cve:struct<id:string,published:string,lastModified:string,descriptions:array<struct<lang:string,value:string>>,metrics:struct<cvssMetricV31:array<struct<cvssData:struct<baseScore:double>>>,cvssMetricV30:array<struct<cvssData:struct<baseScore:double>>>>,references:array<struct<url:string>>>>>"
CLAIM_SCHEMA = "group_name string, post_title string, country string, activity string, published string, discovered string, post_url string"
SAMPLE_SCHEMA = "sha256_hash string, sha1_hash string, md5_hash string, first_seen string, file_name string, signature string, tags array<string>"
URL_COLUMNS = "id string, dateadded string, url string, url_status string, last_online string, threat string, tags string, reporter string"
EOL_SCHEMA = "product string, cycle string, eol string, latest string"
MODEL_SCHEMA = "id string, lastModified string, downloads bigint, siblings array<struct<rfilename:string>>"
ECOSYSTEMS = {"npm": "npm", "PyPI": "pypi", "Go": "go", "Maven": "maven", "RubyGems": "rubygems", "crates.io": "cargo", "NuGet": "nuget", "Packagist": "composer", "Hex": "hex", "Pub": "pub"}
GENERIC_SIGNATURES = ("", "unknown", "malware", "malware_download", "trojan", "n/a")


def shape(rows: DataFrame, **columns: Column) -> DataFrame:
    """The common schema; what a feed doesn't have is null, lists are empty."""

    def of(name: str, kind: str) -> Column:
        made = columns.get(name, F.lit(None)).cast(kind)
        return F.coalesce(made, F.array().cast(kind)) if kind.startswith("array") else made

    return rows.select(*[of(n, k).alias(n) for n, k in COLUMNS.items()])


def _since(stamp: Column, since: str | None) -> Column:
    return F.lit(True) if not since else stamp.isNull() | (stamp >= F.lit(since).cast("timestamp"))


def _ecosystem(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in ECOSYSTEMS.items() for x in item])
    return F.coalesce(F.try_element_at(table, name), F.try_element_at(table, F.substring_index(name, ":", 1)), F.lower(name))


def _ioc(kind: str, value: Column, confidence: float) -> Column:
    return F.when(F.coalesce(value, F.lit("")) != "", F.struct(F.lit(kind).alias("type"), value.alias("value"), F.lit(confidence).alias("confidence")))


def _word_severity(word: Column) -> Column:
    w = F.upper(F.trim(word))
    return F.when(w == "CRITICAL", "critical").when(w == "HIGH", "high").when(w.isin("MODERATE", "MEDIUM"), "medium").otherwise("low")


def osv(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    rows = spark.read.schema(OSV_SCHEMA).option("recursiveFileLookup", True).option("multiLine", True).json(path).filter("id <> '' and size(affected) > 0")
    modified, published = E.rfc3339(F.col("modified")), E.rfc3339(F.col("published"))
    packages = F.transform(F.filter("affected", lambda a: (a["package"]["name"] != "") & (a["package"]["ecosystem"] != "")), lambda a: F.struct(a["package"]["name"].alias("name"), _ecosystem(a["package"]["ecosystem"]).alias("ecosystem"), a["versions"].alias("affected_versions")))
    vector = F.try_element_at(F.filter("severity", lambda s: s["type"].isin("CVSS_V3", "CVSS_V2")), F.lit(1))["score"]
    urls = F.filter(F.col("references.url"), lambda u: u != "")
    text = F.coalesce(F.nullif(F.trim("summary"), F.lit("")), F.nullif(F.trim("details"), F.lit("")), F.concat(F.lit("OSV advisory "), "id"))
    return shape(
        rows.filter(_since(modified, since)),
        id=F.concat(_ecosystem(F.col("affected")[0]["package"]["ecosystem"]), F.lit("-osv-"), "id"),
        source=F.lit("osv"),
        attack_type=F.lit("malicious_publish"),
        severity=F.when(vector.isNotNull(), E.cvss_severity(E.cvss3_base(vector))).otherwise(_word_severity(F.col("database_specific.severity"))),
        description=text,
        published=F.coalesce(published, modified),
        packages=packages,
        references=F.when(F.size(urls) > 0, urls).otherwise(F.array(F.concat(F.lit("https://osv.dev/vulnerability/"), "id"))),
    )


def ghsa(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    rows = spark.read.schema(GHSA_SCHEMA).option("multiLine", True).json(path).filter("ghsa_id <> '' and size(vulnerabilities) > 0")
    packages = F.transform("vulnerabilities", lambda v: F.struct(v["package"]["name"].alias("name"), F.lower(_ecosystem(v["package"]["ecosystem"])).alias("ecosystem"), F.transform(F.split(v["vulnerable_version_range"], ","), lambda x: F.trim(x)).alias("affected_versions")))
    return shape(
        rows.filter(_since(E.rfc3339(F.col("updated_at")), since)),
        id=F.concat(F.lower(_ecosystem(F.col("vulnerabilities")[0]["package"]["ecosystem"])), F.lit("-ghsa-"), "ghsa_id"),
        source=F.lit("ghsa"),
        attack_type=F.lit("malicious_publish"),
        severity=_word_severity(F.col("severity")),
        description=F.col("summary"),
        published=E.rfc3339(F.col("published_at")),
        packages=packages,
        references=F.col("references"),
    )


def kev(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The whole catalogue on every run: it has no cursor."""
    rows = spark.read.schema(KEV_SCHEMA).option("multiLine", True).json(path).select(F.explode("vulnerabilities").alias("v")).select("v.*").filter("cveID <> ''")
    return shape(
        rows,
        id=F.concat(F.lit("cisa-"), "cveID"),
        source=F.lit("cisa"),
        attack_type=F.lit("vulnerability"),
        severity=F.lit("critical"),
        description=F.concat_ws(": ", "vulnerabilityName", "shortDescription"),
        published=F.try_to_timestamp("dateAdded", F.lit("yyyy-MM-dd")),
        references=F.filter(F.transform(F.split("notes", ";"), lambda x: F.trim(x)), lambda u: u.startswith("http")),
        campaign=F.when(F.lower("knownRansomwareCampaignUse") == "known", "ransomware"),
        cve_id=F.col("cveID"),
        exploited=F.lit(True),
    )


def nvd(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    rows = spark.read.schema(NVD_SCHEMA).option("multiLine", True).json(path).select(F.explode("vulnerabilities.cve").alias("c")).select("c.*")
    text = F.coalesce(F.try_element_at(F.filter("descriptions", lambda x: x["lang"] == "en"), F.lit(1))["value"], F.lit(""))
    score = F.coalesce(F.try_element_at("metrics.cvssMetricV31", F.lit(1))["cvssData"]["baseScore"], F.try_element_at("metrics.cvssMetricV30", F.lit(1))["cvssData"]["baseScore"], F.lit(0.0))
    kept = ~text.rlike(r"^\*\* (REJECT|DISPUTED) \*\*") & ((score <= 0) | (score >= 7))
    stamp = F.coalesce(E.rfc3339(F.col("lastModified")), E.rfc3339(F.concat("lastModified", F.lit("Z"))))
    return shape(
        rows.filter(kept & _since(stamp, since)),
        id=F.concat(F.lit("nvd-"), "id"),
        source=F.lit("nvd"),
        attack_type=F.lit("vulnerability"),
        severity=E.cvss_severity(score),
        description=text,
        published=E.rfc3339(F.col("published")),
        references=F.col("references.url"),
        cve_id=F.col("id"),
        cvss=score,
    )


def ransomware_claims(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    rows = spark.read.schema(CLAIM_SCHEMA).option("multiLine", True).json(path).filter("post_title <> ''")
    stamp = F.coalesce(F.nullif(F.col("published"), F.lit("")), F.col("discovered"))
    when = F.coalesce(E.rfc3339(stamp), F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")), F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss")))
    link = F.regexp_replace("post_url", "^(https?):/(?!/)", "$1://")
    link = F.when(link.rlike("^https?://"), link)
    about = F.concat_ws("; ", F.concat(F.lit("Claim by "), E.flatten_space(F.col("group_name")), F.lit(" against "), E.flatten_space(F.col("post_title"))), F.when(F.col("country") != "", F.concat(F.lit("country: "), E.flatten_space(F.col("country")))), F.when(F.col("activity") != "", F.concat(F.lit("sector: "), E.flatten_space(F.col("activity")))))
    made = shape(
        rows.filter(_since(when, since)),
        id=F.concat_ws("-", F.lit("ransomware_live"), E.slug(F.col("group_name")), E.slug(F.col("post_title")), F.date_format(when, "yyyyMMdd")),
        source=F.lit("ransomware_live"),
        attack_type=F.lit("ransomware"),
        severity=F.lit("high"),
        description=about,
        published=when,
        references=F.array_compact(F.array(link)),
        iocs=F.array_compact(F.array(_ioc("url", link, 0.9))),
        campaign=F.col("group_name"),
    )
    return made.dropDuplicates(["id"])


def malicious_urls(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    rows = spark.read.schema(URL_COLUMNS).option("comment", "#").option("mode", "PERMISSIVE").csv(path).filter("url <> '' and coalesce(url_status, '') <> 'offline'")
    when = F.try_to_timestamp("dateadded", F.lit("yyyy-MM-dd HH:mm:ss"))
    host = F.lower(E.url_host(F.col("url")))
    return shape(
        rows.filter(_since(when, since)),
        id=F.concat(F.lit("urlhaus-"), "id"),
        source=F.lit("urlhaus"),
        attack_type=F.lit("malware"),
        severity=F.lit("high"),
        description=F.concat(F.lit("URL that spreads "), F.coalesce("threat", F.lit("malware")), F.lit(", tagged "), F.coalesce("tags", F.lit("nothing"))),
        published=when,
        iocs=F.array_compact(F.array(_ioc("url", F.col("url"), 0.9), _ioc("domain", host, 0.8))),
        campaign=F.when(~F.lower("threat").isin("", "unknown"), F.col("threat")),
    )


def malware_samples(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    rows = spark.read.schema(SAMPLE_SCHEMA).option("multiLine", True).json(path).filter("length(sha256_hash) >= 16")
    when = F.try_to_timestamp("first_seen", F.lit("yyyy-MM-dd HH:mm:ss"))
    return shape(
        rows.filter(_since(when, since)),
        id=F.concat(F.lit("malware_bazaar-"), F.lower(F.substring("sha256_hash", 1, 16))),
        source=F.lit("malware_bazaar"),
        attack_type=F.lit("malware"),
        severity=F.lit("high"),
        description=F.concat_ws(" ", F.lit("Sample"), "file_name", "signature"),
        published=when,
        iocs=F.array_compact(F.array(*[_ioc(k, F.col(f"{k}_hash"), 0.9) for k in ("sha256", "sha1", "md5")])),
        campaign=F.when(~F.lower("signature").isin(*GENERIC_SIGNATURES), F.col("signature")),
    )


def end_of_life(spark: SparkSession, path: str, since: str | None = None, now: str | None = None) -> DataFrame:
    """Cycles whose end lies between since and now; the id has the cycle, so that no two collide."""
    rows = spark.read.schema(EOL_SCHEMA).json(path)
    day = F.try_to_timestamp("eol", F.lit("yyyy-MM-dd"))
    past = day < (F.lit(now).cast("timestamp") if now else F.current_timestamp())
    return shape(
        rows.filter(day.isNotNull() & past & _since(day, since)),
        id=F.concat_ws("-", F.lit("container-eol"), F.lower("product"), E.slug(F.col("cycle")), F.date_format(day, "yyyy")),
        source=F.lit("eol_date"),
        attack_type=F.lit("eol"),
        severity=F.lit("high"),
        description=F.concat_ws(" ", "product", "cycle", F.lit("has had no patches since"), "eol"),
        published=day,
        references=F.array(F.concat(F.lit("https://endoflife.date/"), "product")),
    )


def model_files(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Model repositories with binary weights: beside safe ones (format_downgrade) or alone (unexpected_binary)."""
    rows = spark.read.schema(MODEL_SCHEMA).json(path)
    names = F.transform(F.col("siblings.rfilename"), F.lower)
    safe, binary = F.exists(names, lambda f: f.endswith(".safetensors")), F.filter(names, lambda f: f.endswith(".bin") | f.endswith(".pt"))
    each = F.transform(binary, lambda f: F.struct(F.lit("unexpected_binary").alias("type"), f.alias("value"), F.lit(0.60).alias("confidence")))
    one = F.array(F.struct(F.lit("format_downgrade").alias("type"), F.col("id").alias("value"), F.lit(0.75).alias("confidence")))
    return shape(
        rows.filter((F.size(binary) > 0) & _since(E.rfc3339(F.col("lastModified")), since)),
        id=F.concat(F.lit("huggingface-"), F.replace(F.col("id"), F.lit("/"), F.lit("-"))),
        source=F.lit("huggingface"),
        attack_type=F.when(safe, "model_poisoning").otherwise("malicious_publish"),
        severity=F.lit("high"),
        description=F.concat(F.lit("Unsafe files in the model "), "id"),
        published=E.rfc3339(F.col("lastModified")),
        packages=F.array(F.struct(F.col("id").alias("name"), F.lit("huggingface").alias("ecosystem"), F.array().cast("array<string>").alias("affected_versions"))),
        iocs=F.when(safe, one).otherwise(each),
    )


READERS: dict[str, Callable[..., DataFrame]] = {"osv": osv, "ghsa": ghsa, "cisa": kev, "nvd": nvd, "ransomware_live": ransomware_claims, "urlhaus": malicious_urls, "malware_bazaar": malware_samples, "eol_date": end_of_life, "huggingface": model_files}


def read(spark: SparkSession, name: str, path: str, since: str | None = None) -> DataFrame:
    if name not in READERS:
        raise KeyError(f"no source {name}; there are {', '.join(sorted(READERS))}")
    return READERS[name](spark, path, since)
