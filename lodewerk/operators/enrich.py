"""What other tables know about an incident's indicators and CVEs, and what was curated by hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import gates as G
from . import pairs

RELATED_CONFIDENCE = 0.55
PACKAGE_CONFIDENCE, LINK_CONFIDENCE = 0.85, 0.9


def curated_first(curated: DataFrame, bulk: DataFrame, key: str = "id") -> DataFrame:
    """Curated rows, and bulk rows of ids that aren't curated."""
    return curated.unionByName(bulk.join(curated.select(key).distinct(), key, "left_anti").select(*curated.columns))


def stale_rules(rules: DataFrame, known: DataFrame) -> DataFrame:
    """Rules whose incident isn't known any more; none if nothing is known at all."""
    return rules.join(known.select(F.col("id").alias("incident_id")).distinct(), "incident_id", "left_anti").join(known.select(F.lit(1).alias("_any")).limit(1), how="left_semi", on=F.lit(True))


def rules_to_incidents(files: DataFrame, incidents: DataFrame) -> DataFrame:
    """(file, id): the incident whose id is the longest beginning, up to a dash and of four parts at least, of a rule file's name."""
    parts = F.split(F.regexp_replace("file", r"\.[A-Za-z0-9]+$", ""), "-")
    heads = files.withColumn("_p", parts).withColumn("_n", F.explode(F.sequence(F.lit(4), F.greatest(F.size("_p"), F.lit(4))))).filter(F.col("_n") <= F.size("_p"))
    named = heads.select("file", F.array_join(F.slice("_p", 1, F.col("_n")), "-").alias("id"), "_n").join(incidents.select("id").distinct(), "id")
    return named.groupBy("file").agg(F.max_by("id", "_n").alias("id"))


def to_look_up(indicators: DataFrame, cache: DataFrame, now: Column, days: int) -> DataFrame:
    """Distinct (type, value) of addresses and domains without a fresh cache entry."""
    wanted = indicators.filter("type in ('ip', 'domain') and value is not null").select("type", "value").distinct()
    return wanted.join(cache.filter(G.fresh(F.col("fetched"), now, days)).select("type", "value").distinct(), ["type", "value"], "left_anti")


def with_cache(indicators: DataFrame, cache: DataFrame) -> DataFrame:
    """Indicators (id, type, value, source, confidence) with what the cache has (info), and rows for related domains that an incident doesn't have yet."""
    joined = indicators.join(cache.select("type", "value", "info", "related"), ["type", "value"], "left")
    rows = joined.select("id", "type", "value", "source", "confidence", "info")
    more = joined.filter("type = 'domain'").select("id", "type", F.explode("related").alias("value")).distinct().join(indicators.filter("type = 'domain'").select("id", "type", "value"), ["id", "type", "value"], "left_anti")
    return rows.unionByName(more.select("id", "type", "value", F.lit("crt.sh").alias("source"), F.lit(RELATED_CONFIDENCE).alias("confidence"), F.lit(None).cast("string").alias("info")))


def exploit_traits(cves: DataFrame, exploits: DataFrame) -> DataFrame:
    """(id, cve, traits): CVE rows without traits get those of known exploits of the CVE that aren't local or for denial of service."""
    usable = exploits.filter("kind not in ('local', 'dos')").select(F.upper("cve").alias("_cve"), "type", "value").distinct()
    by = usable.groupBy("_cve").agg(F.count("*").alias("traits"))
    return cves.filter("traits = 0 and cve <> ''").drop("traits").join(by, F.upper("cve") == F.col("_cve")).drop("_cve")


def os_links(packages: DataFrame, containers: DataFrame) -> DataFrame:
    """(src_id, dst_id, src_module, cve, confidence): OS packages and containers with a CVE in common, both ways, once a pair with the least such CVE.

    Each row has its incident's lesser CVEs with it, so a pair knows by itself
    whether it has met before and pairs needn't be brought together.
    """

    def sided(rows: DataFrame, side: int) -> DataFrame:
        every = rows.select("id", "cve").filter("cve is not null").distinct()
        several = every.groupBy(F.col("id").alias("_id")).agg(F.collect_set("cve").alias("all")).filter("size(all) > 1")  # an incident's CVEs
        joined = every.join(several, F.expr("id <=> _id"), "left")
        return joined.select("cve", "id", F.filter(F.coalesce("all", F.array().cast("array<string>")), lambda c: c < F.col("cve")).alias("less"), F.lit(side).alias("side"))

    packed = pairs.blocks(sided(packages, 1).unionByName(sided(containers, 2)), "cve", "side", "id", "less")
    met = pairs.of_blocks(packed, packed, "cve", F.expr("x_side <> y_side"), "id", "less").filter("size(x_less) = 0 or size(y_less) = 0 or not arrays_overlap(x_less, y_less)")
    module = F.when(F.col("x_side") == 1, "os-packages").otherwise("container")
    return met.select(F.col("x_id").alias("src_id"), F.col("y_id").alias("dst_id"), module.alias("src_module"), "cve", F.lit(LINK_CONFIDENCE).alias("confidence"))


def installed_packages(packages: DataFrame, containers: DataFrame, versions: DataFrame) -> DataFrame:
    """(id, value, confidence): containers get a name/version for each affected version of the OS packages that they share a CVE with.

    The values of a CVE are the same for all its containers, so packages become
    distinct values before they meet containers.
    """
    value = F.concat_ws("/", "name", "version").alias("value")
    values = packages.select("id", "cve").distinct().join(versions.select("id", value).distinct(), "id").select("cve", "value").distinct()
    return values.join(containers.select("id", "cve").distinct(), "cve").select("id", "value").distinct().withColumn("confidence", F.lit(PACKAGE_CONFIDENCE))


def actor_links(incidents: DataFrame) -> DataFrame:
    """(actor, src_id, dst_id, confidence): incidents of an actor that spans several modules, each tied to the actor's first; the confidence is the greater level of the two."""
    level = E.lookup(F.lower(F.coalesce("level", F.lit(""))), G.CAMPAIGN_CONFIDENCE, 0.60)
    rows = incidents.filter("actor <> ''").select("actor", "module", "id", level.alias("c"))
    hubs = rows.groupBy("actor").agg(F.min("id").alias("src_id"), F.min_by("c", "id").alias("c0"), F.count_distinct("module").alias("modules")).filter("modules > 1")
    return rows.join(hubs, "actor").filter("id <> src_id").select("actor", "src_id", F.col("id").alias("dst_id"), F.greatest("c", "c0").alias("confidence"))


def impact(packages: DataFrame, popular: DataFrame) -> DataFrame:
    """(id, packages, top, total, rating): by incident its popular packages, the most and all of their downloads, and the rating of the most."""
    joined = packages.select("id", "ecosystem", "name").join(popular, ["ecosystem", "name"])
    by = joined.groupBy("id").agg(F.count("*").alias("packages"), F.max("weekly").alias("top"), F.sum("weekly").alias("total"))
    return by.withColumn("rating", E.impact_rating(F.col("top")))
