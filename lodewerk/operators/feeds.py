"""Feeds that only grow: what is there and what is new, filtered, once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import gates as G
from .index import keep_first


def append_lines(there: DataFrame, new: DataFrame, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """The distinct lines (value) of both that pass the gate; what was there is tested again. Order is the sink's."""
    both = there.select("value").unionByName(new.select("value")).filter("value is not null")
    return (both.filter(keep(F.col("value"))) if keep else both).distinct()


def append_unified(there: DataFrame, new: DataFrame) -> DataFrame:
    """Entries by (type, value, incident): valid ones that were there win; new ones have passed their gates already."""
    old = there.filter(G.feed_entry(F.col("type"), F.col("value"))).withColumn("_new", F.lit(0))
    both = old.unionByName(new.withColumn("_new", F.lit(1)))
    return keep_first(both, ["type", "value", "incident_id"], ["_new"]).drop("_new")


def export(indicators: DataFrame) -> DataFrame:
    """(feed, value): what of (type, value) goes into the text feeds; addresses filed as domains are promoted, hashes go by their kind."""
    address = (F.col("type") == "domain") & G.is_ip(F.col("value"))
    kind = F.when(address, "ip").otherwise(F.col("type"))
    fit = F.when(kind == "ip", G.feed_ip(F.col("value"))).when(kind == "domain", G.feed_domain(F.col("value"))).otherwise(F.col("type").isin("sha256", "sha1", "md5"))
    return indicators.withColumn("feed", kind).filter(fit).select("feed", "value").distinct()


def image_feed(there: DataFrame, images: DataFrame, ended: DataFrame) -> DataFrame:
    """Container images by (repository, tag, incident_id): those that were there, then a row for each vulnerable tag, then those at their end of life."""
    columns = ["type", "repository", "tag", "tier", "incident_id", "confidence"]
    tags = images.select(F.lit("container_image").alias("type"), "repository", F.explode("tags").alias("tag"), "tier", "incident_id", "confidence")
    eol = ended.select(F.lit("container_image_eol").alias("type"), "repository", F.col("cycle").alias("tag"), "tier", "incident_id", F.lit(None).cast("double").alias("confidence"))
    both = there.select(*columns, F.lit(0).alias("_at")).unionByName(tags.withColumn("_at", F.lit(1))).unionByName(eol.withColumn("_at", F.lit(2)))
    return keep_first(both, ["repository", "tag", "incident_id"], ["_at"]).drop("_at")


def distinct_traits(traits: DataFrame, keys: list[str]) -> DataFrame:
    """HTTP traits by (keys, type, value), the most certain of equal ones."""
    return traits.groupBy(*keys, "type", "value").agg(F.max("confidence").alias("confidence"))


def in_order(entries: DataFrame) -> DataFrame:
    """Feed entries in the order in which they are written: for a sink, not for further joins."""
    return entries.orderBy("type", "value", "incident_id")
