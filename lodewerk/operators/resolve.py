"""Entity resolution: edges between rows that are one incident, components, survivors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from .components import connected_components

TRUSTED = ("wiz", "socket", "aikido", "stepsecurity")


def star_edges(keys: DataFrame) -> DataFrame:
    """From (key, id) the edges of each key's rows to its least: no more than rows, however many share a key; rows with several keys in common repeat them."""
    order = Window.partitionBy("key")
    return keys.filter("key is not null and key <> ''").withColumn("src", F.min("id").over(order)).filter("src <> id").select("src", F.col("id").alias("dst"))


def event_edges(incidents: DataFrame, days: int = 7) -> DataFrame:
    """Pairs at most so many days apart that share two indicators, or one if both sources are trusted: a report of all pairs; ``entities.event_edges`` has the same components with fewer edges than rows."""
    span = days * 86_400_000_000
    rows = incidents.filter("ioc is not null and start_ts is not null").select("id", "ioc", F.unix_micros(F.col("start_ts").cast("timestamp")).alias("at"), F.col("source").isin(*TRUSTED).alias("ok"))
    a = rows.select(F.col("id").alias("src"), "ioc", F.floor(F.col("at") / span).alias("bin"), F.col("at").alias("t1"), F.col("ok").alias("ok1"))
    b = rows.select(F.col("id").alias("dst"), "ioc", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda k: F.floor(F.col("at") / span) + k)).alias("bin"), F.col("at").alias("t2"), F.col("ok").alias("ok2"))
    pairs = a.join(b, ["ioc", "bin"]).filter((F.col("src") < F.col("dst")) & (F.abs(F.col("t1") - F.col("t2")) <= span)).groupBy("src", "dst").agg(F.count_distinct("ioc").alias("shared"), F.bool_and(F.col("ok1") & F.col("ok2")).alias("trusted"))
    return pairs.filter("shared >= case when trusted then 1 else 2 end").select("src", "dst")


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) of all vertices; one without edges is its own."""
    found = connected_components(edges)
    return vertices.select("id").join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def survivors(incidents: DataFrame, named: DataFrame) -> DataFrame:
    """One row for each component: base fields from its least id, the worst severity, the longest description, all sources."""
    rows = incidents.join(named, "id")
    return rows.groupBy("component").agg(
        F.count("*").alias("members"),
        F.min_by("module", "id").alias("module"),
        E.severity_label(F.max(E.severity_rank(F.col("severity")))).alias("severity"),
        F.max_by("description", F.struct(F.octet_length("description"), -F.col("id"))).alias("description"),
        F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"),
        F.round(E.confidence(F.sort_array(F.collect_set("source"))), 6).alias("confidence"),
        F.min("start_ts").alias("first_seen"),
    )
