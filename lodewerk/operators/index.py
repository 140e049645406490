"""Projections, inverted indexes, listings, rollups and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from . import ids


def module_stats(incidents: DataFrame) -> DataFrame:
    """Counts by module and over all (module 'total')."""
    return incidents.rollup("module").agg(F.count("*").alias("incidents"), F.count_distinct("ioc").alias("iocs"), F.count_if(F.col("severity") == "critical").alias("critical")).withColumn("module", F.coalesce("module", F.lit("total")))


def campaigns(incidents: DataFrame) -> DataFrame:
    """By campaign name: module and confidence of its least id, how many, first and last seen."""
    named = incidents.filter("campaign <> ''")
    return named.groupBy("campaign").agg(F.min_by("module", "id").alias("module"), F.round(F.min_by("confidence", "id"), 6).alias("confidence"), F.count("*").alias("incidents"), F.min("start_ts").alias("first_seen"), F.max("start_ts").alias("last_seen"))


def recent(incidents: DataFrame, n: int = 20) -> DataFrame:
    """The n newest incidents; ties by id."""
    return incidents.orderBy(F.desc_nulls_last("start_ts"), "id").limit(n).select("id", "module", "severity", "start_ts")


def curated(incidents: DataFrame, now: Column, days: int = 90) -> DataFrame:
    """Critical or high, medium in the supply module, with a campaign, or newer than so many days."""
    new = F.unix_seconds(F.col("start_ts").cast("timestamp")) > F.unix_seconds(now.cast("timestamp")) - days * 86400
    keep = F.col("severity").isin("critical", "high") | ((F.col("module") == "supply") & (F.col("severity") == "medium")) | (F.col("campaign") != "") | new
    return incidents.filter(F.coalesce(keep, F.lit(False)))


def search_rows(incidents: DataFrame) -> DataFrame:
    """The search projection: tags with prefixes, the shard of the name, the day."""
    tags = F.array_sort(F.array_compact(F.array(F.concat(F.lit("module:"), "module"), F.concat(F.lit("severity:"), "severity"), F.when(F.col("campaign") != "", F.concat(F.lit("campaign:"), E.slug(F.col("campaign")))))))
    return incidents.select("id", F.array_join(tags, " ").alias("tags"), E.shard_key(F.col("package")).alias("shard"), F.date_format("start_ts", "yyyy-MM-dd").alias("published"))


def inverted(rows: DataFrame, key: Column, item: Column) -> DataFrame:
    """(key, n, items): the distinct items of each key in order."""
    keyed = rows.select(key.alias("key"), item.cast("bigint").alias("item")).filter("key is not null and item is not null").distinct()
    return keyed.groupBy("key").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda x: x.cast("string")), ",").alias("items"))


def assign_ids(rows: DataFrame, prefix: str = "lw") -> DataFrame:
    """Sequential ids for each module and year, in order of id, of six digits or more."""
    numbered = ids.assign(rows.select("module", F.year("start_ts").alias("year"), F.col("id").alias("source_id")), None, prefix, 6)
    return numbered.select(F.col("source_id").alias("id"), "public_id")


def previous_values(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows with the value before them in their key."""
    return rows.withColumn("previous", F.lag(value).over(Window.partitionBy(key).orderBy(*order)))


def dangling(references: DataFrame, known: DataFrame, column: str, key: str) -> DataFrame:
    """References without a target."""
    return references.filter(F.col(column).isNotNull()).join(known.select(F.col(key).alias(column)), column, "left_anti")


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key: rows that were there win over new ones if ``order`` puts them first."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def changed(current: DataFrame, cached: DataFrame, key: str = "id", digest: str = "hash") -> DataFrame:
    """Rows that are new or whose digest differs from the cached one."""
    old = cached.select(key, F.col(digest).alias("_old"))
    return current.join(old, key, "left").filter(F.col("_old").isNull() | (F.col("_old") != F.col(digest))).drop("_old")


def consistency(incidents: DataFrame, feed: DataFrame) -> DataFrame:
    """By module: incidents, feed rows, and whether they drift apart by more than one in a hundred."""
    a = incidents.groupBy("module").agg(F.count("*").alias("incidents"))
    b = feed.groupBy("module").agg(F.count("*").alias("entries"))
    joined = a.join(b, "module", "full").select("module", F.coalesce("incidents", F.lit(0)).alias("incidents"), F.coalesce("entries", F.lit(0)).alias("entries"))
    return joined.withColumn("drift", F.abs(F.col("incidents") - F.col("entries")) > 0.01 * F.col("incidents"))


def shrink_guard(before: int, after: int) -> None:
    """Refuses to overwrite more than 1,000 rows with fewer than half of them."""
    if before > 1000 and after * 2 < before:
        raise ValueError(f"{before} rows would shrink to {after}")


def summaries(incidents: DataFrame, packages: DataFrame, indicators: DataFrame) -> DataFrame:
    """A short row for each incident: its distinct sources (its own first), the ecosystem of its first package, how many packages and indicators it has, how many of these are shown (no URLs), the day."""
    of_packages = packages.groupBy("id").agg(F.min_by("ecosystem", "pos").alias("ecosystem"), F.count("*").alias("packages"))
    of_indicators = indicators.filter("value is not null").groupBy("id").agg(F.count("*").alias("indicators"), F.count_if(F.col("type") != "url").alias("shown"))
    sources = F.array_join(F.array_distinct(F.concat(F.array("source"), F.coalesce("sources", F.array().cast("array<string>")))), ",")
    rows = incidents.select("id", "module", "severity", sources.alias("sources"), F.date_format("start_ts", "yyyy-MM-dd").alias("published"))
    return rows.join(of_packages, "id", "left").join(of_indicators, "id", "left").fillna(0, ["packages", "indicators", "shown"])


def health(runs: DataFrame) -> DataFrame:
    """(status, sources, names) of fetches (source, rows, error): which ended with an error, without rows, or well."""
    status = F.when(F.col("error").isNotNull(), "errored").when(F.coalesce("rows", F.lit(0)) == 0, "empty").otherwise("ok")
    return runs.groupBy(status.alias("status")).agg(F.count("*").alias("sources"), F.array_join(F.array_sort(F.collect_list("source")), ",").alias("names"))  # a row for each source


def probe(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """By source of (source, id, matched, type): articles, how many matched, and indicators of each kind."""
    return found.groupBy("source").agg(F.count_distinct("id").alias("articles"), F.count_distinct(F.when(F.col("matched"), F.col("id"))).alias("matched"), *(F.count_if(F.col("type") == k).alias(k) for k in kinds))
