"""Incidents as a graph of objects and relationships."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E


def objects(incidents: DataFrame) -> DataFrame:
    """(id, type, name) of the distinct vulnerabilities, campaigns and indicators of incidents."""

    def of(kind: str, value):
        return F.struct(F.lit(kind).alias("type"), value.alias("name"))

    each = F.array(of("vulnerability", F.upper("cve")), of("campaign", F.nullif(F.col("campaign"), F.lit(""))), of("indicator", F.concat_ws(":", "ioc_type", "ioc")))
    rows = incidents.select(F.explode(each).alias("o")).select("o.*").filter("name is not null").distinct()
    return rows.select(F.concat(F.col("type"), F.lit("--"), E.uuid5(F.concat_ws(":", "type", "name"))).alias("id"), "type", "name")


def relationships(incidents: DataFrame) -> DataFrame:
    """(source_name, relation, target_name): indicators indicate campaigns, campaigns target vulnerabilities."""
    ioc = F.concat_ws(":", "ioc_type", "ioc")
    named = incidents.filter("campaign <> '' and ioc is not null")
    a = named.select(ioc.alias("source_name"), F.lit("indicates").alias("relation"), F.col("campaign").alias("target_name"))
    b = named.select(F.col("campaign").alias("source_name"), F.lit("targets").alias("relation"), F.upper("cve").alias("target_name"))
    return a.unionByName(b).distinct()


def unresolved(relations: DataFrame, known: DataFrame) -> DataFrame:
    """Relationships with an end that is no object."""
    names = known.select("name")
    both = relations.join(names.withColumnRenamed("name", "source_name"), "source_name", "left_semi").join(names.withColumnRenamed("name", "target_name"), "target_name", "left_semi")
    return relations.join(both, relations.columns, "left_anti")
