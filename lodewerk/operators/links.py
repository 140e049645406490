"""Joins across modules: shared indicators, actors and CVEs, claims, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from . import actors, pairs


def combined_feed(incidents: DataFrame) -> DataFrame:
    """By (type, value): modules, incidents, the greatest confidence raised by 0.08 for each further module, 0.98 at most."""
    n = F.count_distinct("module")
    feed = incidents.filter("ioc is not null").groupBy("ioc_type", "ioc").agg(n.alias("modules"), F.count_distinct("id").alias("incidents"), F.max("confidence").alias("confidence"))
    boosted = F.when(F.col("modules") > 1, F.least(F.col("confidence") + 0.08 * (F.col("modules") - 1), F.lit(0.98))).otherwise(F.col("confidence"))
    return feed.withColumn("cross_domain", F.col("modules") > 1).withColumn("boosted", F.round(boosted, 6)).withColumn("confidence", F.round("confidence", 6))


def cross_module_sources(incidents: DataFrame) -> DataFrame:
    """(id, boosted, modules): incidents whose indicator stands in several modules."""
    by = incidents.filter("ioc is not null").groupBy("ioc").agg(F.count_distinct("module").alias("n"), F.array_join(F.sort_array(F.collect_set("module")), ",").alias("modules"))
    joined = incidents.join(by.filter("n > 1"), "ioc")
    return joined.select("id", "ioc", "modules", F.round(F.least(F.col("confidence") + 0.08 * (F.col("n") - 1), F.lit(0.98)), 6).alias("boosted"))


def shared_infrastructure(incidents: DataFrame, days: int = 7) -> DataFrame:
    """Pairs (src_id < dst_id) that share an indicator within so many days; within one module too.

    Rows meet by indicator and stretch of so many days, the one after it and the
    one before, so an indicator that is seen for years pairs neighbours only.
    """
    rows = incidents.filter("ioc is not null and start_ts is not null").select("ioc", "id", "module", F.unix_micros(F.col("start_ts").cast("timestamp")).alias("at"))
    span = days * 86_400_000_000
    a = rows.select("ioc", F.floor(F.col("at") / span).alias("bin"), F.col("id").alias("src_id"), F.col("module").alias("src_module"), F.col("at").alias("src_at"))
    b = rows.select("ioc", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda k: F.floor(F.col("at") / span) + k)).alias("bin"), F.col("id").alias("dst_id"), F.col("module").alias("dst_module"), F.col("at").alias("dst_at"))
    return a.join(b, ["ioc", "bin"]).filter((F.col("src_id") < F.col("dst_id")) & (F.abs(F.col("src_at") - F.col("dst_at")) <= span)).select("src_id", "src_module", "dst_id", "dst_module").distinct()


def shared_actor(incidents: DataFrame) -> DataFrame:
    """Campaigns that span several modules with their modules, incidents and greatest confidence: links as stars, not pairs."""
    named = incidents.filter("campaign <> ''").groupBy("campaign").agg(F.min("id").alias("hub"), F.count_distinct("module").alias("modules"), F.max("confidence").alias("confidence"))
    return incidents.join(named.filter("modules > 1").select("campaign", "hub", F.col("confidence").alias("link_confidence")), "campaign").filter("id <> hub").select(F.col("hub").alias("src_id"), F.col("id").alias("dst_id"), "campaign", F.round("link_confidence", 6).alias("confidence"))


def cve_links(incidents: DataFrame, one: str = "cve", other: str = "container") -> DataFrame:
    """Links in both directions between incidents of two modules with the same CVE, each once.

    A row's side says which of the modules have it (1, 2, or 3 for both), so no
    link is made twice and none has to be sought among the others.
    """
    rows = incidents.filter(F.col("module").isin(one, other)).select(F.upper("cve").alias("cve"), "id", "module")
    sides = rows.groupBy("cve", "id").agg((F.max((F.col("module") == one).cast("int")) + 2 * F.max((F.col("module") == other).cast("int"))).alias("side"))
    packed = pairs.blocks(sides, "cve", "side", "id")
    meet = F.expr("(x_side & 1 > 0 and y_side & 2 > 0) or (x_side & 2 > 0 and y_side & 1 > 0)")
    return pairs.of_blocks(packed, packed, "cve", meet, "id").select(F.col("x_id").alias("src_id"), F.col("y_id").alias("dst_id"), "cve")


def claim(rows: DataFrame, key: str, rank: str, pos: str) -> DataFrame:
    """One row for each key: the first module by rank keeps it."""
    order = Window.partitionBy(key).orderBy(rank, pos)
    return rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def popularity(incidents: DataFrame, packages: DataFrame) -> DataFrame:
    """Incidents with the downloads of their package and its impact; without a match 0 and negligible."""
    joined = incidents.join(packages, ["ecosystem", "name"], "left")
    weekly = F.coalesce("weekly", F.lit(0))
    return joined.withColumn("weekly", weekly).withColumn("impact", E.impact_rating(weekly))


def alias_matches(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, slug): aliases (in lower case) of six letters or more anywhere, shorter ones as words; each text is read once."""
    return actors.text_matches(texts, aliases).distinct()


def cross_domain(values: DataFrame) -> DataFrame:
    """(value, src_id, dst_id, src_module, dst_module) of (value, id, module): values that stand in several modules tie each of their incidents to the first."""
    hubs = values.groupBy("value").agg(F.min("id").alias("src_id"), F.min_by("module", "id").alias("src_module"), F.count_distinct("module").alias("n")).filter("n > 1").drop("n")
    return values.join(hubs, "value").filter("id <> src_id").select("value", "src_id", F.col("id").alias("dst_id"), "src_module", F.col("module").alias("dst_module")).distinct()
