"""The driver's tables in the roles of incidents, advisories, packages and claims; each as a DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E

NOW = "2024-02-15 00:00:00"
MODULE = {"click": "supply", "view": "malware", "purchase": "ransomware", "error": "cve", "signup": "container"}
SOURCES = ("wiz", "socket", "osv", "nvd", "talos")


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as incidents of one indicator, package and CVE each."""
    e = table(spark, sf_dir, "events")
    module = F.create_map(*[F.lit(x) for item in MODULE.items() for x in item])
    cvss = F.least(F.col("value") / 50, F.lit(10.0))
    return e.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("start_ts"),
        "user_id",
        F.coalesce(F.try_element_at(module, F.col("event_type")), F.lit("os-packages")).alias("module"),
        F.element_at(F.array(*map(F.lit, SOURCES)), (F.col("event_id") % 5 + 1).cast("int")).alias("source"),
        cvss.alias("cvss"),
        E.cvss_severity(cvss).alias("severity"),
        F.when(F.col("user_id") % 3 == 0, "ip").when(F.col("user_id") % 3 == 1, "domain").otherwise("sha256").alias("ioc_type"),
        F.concat(F.col("user_id"), F.lit(":"), F.get_json_object("props", "$.k")).alias("ioc"),
        F.concat(F.lit("Pkg-"), F.col("user_id") % 40).alias("package"),
        F.when(F.col("event_id") % 2 == 0, "npm").otherwise("PyPI").alias("ecosystem"),
        F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("Campaign "), F.col("user_id") % 12)).otherwise("").alias("campaign"),
        F.concat(F.lit("cve-2024-"), F.col("event_id") % 700).alias("cve"),
        F.coalesce(F.col("value"), F.lit(0.0)).alias("value"),
    ).withColumn("confidence", E.confidence(F.array("source")))


INC = f"""inc AS (SELECT event_id AS id, ts AS start_ts, user_id, coalesce(value, 0.0) AS value,
  CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in MODULE.items())} ELSE 'os-packages' END AS module,
  CASE event_id % 5 WHEN 0 THEN 'wiz' WHEN 1 THEN 'socket' WHEN 2 THEN 'osv' WHEN 3 THEN 'nvd' ELSE 'talos' END AS source,
  least(value / 50, 10.0) AS cvss,
  CASE WHEN value / 50 >= 9 THEN 'critical' WHEN value / 50 >= 7 THEN 'high' WHEN value / 50 >= 4 THEN 'medium' ELSE 'low' END AS severity,
  CASE user_id % 3 WHEN 0 THEN 'ip' WHEN 1 THEN 'domain' ELSE 'sha256' END AS ioc_type,
  user_id || ':' || regexp_extract(props, '"k": *([0-9]+)', 1) AS ioc,
  'Pkg-' || (user_id % 40) AS package, CASE event_id % 2 WHEN 0 THEN 'npm' ELSE 'PyPI' END AS ecosystem,
  CASE WHEN user_id % 4 = 0 THEN 'Campaign ' || (user_id % 12) ELSE '' END AS campaign,
  'cve-2024-' || (event_id % 700) AS cve,
  CAST(CASE event_id % 5 WHEN 0 THEN 0.90 WHEN 1 THEN 0.90 WHEN 2 THEN 0.95 WHEN 3 THEN 0.92 ELSE 0.85 END AS DOUBLE) AS confidence FROM events)"""


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as packages with the quantity sold as weekly downloads."""
    p, li = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    sold = li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    return p.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").groupBy(F.col("p_name").alias("name"), F.col("p_type").alias("ecosystem")).agg(F.coalesce(F.sum("q"), F.lit(0.0)).cast("bigint").alias("weekly"))


PKG = """pkg AS (SELECT p_name AS name, p_type AS ecosystem, CAST(coalesce(sum(q), 0) AS BIGINT) AS weekly
  FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON p_partkey = l_partkey GROUP BY 1, 2)"""
