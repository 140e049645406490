"""Public ids that stay: a registry of issued ones, and rewriting references to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import cut


def assign(rows: DataFrame, registry: DataFrame | None, prefix: str = "lw", digits: int = 4) -> DataFrame:
    """(module, year, source_id, seq, public_id) of all rows (module, year, source_id): issued ids stay, new ones follow their module's and year's last in order of source id.

    Numbers are given by range partitions: each counts its own rows and adds
    what stands before it, so no task sorts a whole year.  Numbers beyond
    ``digits`` digits are longer, never cut off.  Rows without a module, year or
    source id get none.
    """
    keys = ["module", "year"]
    known = rows.select(*keys, "source_id").distinct()
    if registry is None:
        registry = known.limit(0).withColumn("seq", F.lit(0).cast("bigint"))
    issued = registry.groupBy(*keys, "source_id").agg(F.min("seq").alias("seq"))
    fresh = known.join(issued, [*keys, "source_id"], "left_anti")
    parts = cut(fresh.repartitionByRange(*keys, "source_id").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part", *keys).orderBy("source_id")
    ahead = parts.groupBy(*keys, "part").agg(F.count("*").alias("n"))  # a row for each part of a year
    before = ahead.withColumn("ahead", F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    last = issued.groupBy(*keys).agg(F.max("seq").alias("last"))
    numbered = parts.withColumn("own", F.row_number().over(inside)).join(before, [*keys, "part"]).join(last, keys, "left")
    made = numbered.select(*keys, "source_id", (F.coalesce("last", F.lit(0)) + F.col("ahead") + F.col("own")).cast("bigint").alias("seq"))
    every = made.unionByName(known.join(issued, [*keys, "source_id"]).select(*keys, "source_id", F.col("seq").cast("bigint")))
    number = F.when(F.length(F.col("seq").cast("string")) < digits, F.lpad(F.col("seq").cast("string"), digits, "0")).otherwise(F.col("seq").cast("string"))
    return every.withColumn("public_id", F.concat_ws("-", F.lit(prefix), "module", F.col("year").cast("string"), number))


def merge_registries(disk: DataFrame, memory: DataFrame) -> DataFrame:
    """(module, year, source_id, seq): the union of both; what is in memory wins."""
    both = disk.withColumn("_at", F.lit(1)).unionByName(memory.withColumn("_at", F.lit(0)))
    return both.groupBy("module", "year", "source_id").agg(F.min_by("seq", "_at").alias("seq"))


def counters(registry: DataFrame) -> DataFrame:
    return registry.groupBy("module", "year").agg(F.max("seq").alias("counter"))


def rewrite(rows: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Rows whose column is an old id of (old, new) get the new one; others stay."""
    joined = rows.join(mapping.select(F.col("old").alias(column), F.col("new").alias("_new")), column, "left")
    return joined.withColumn(column, F.coalesce("_new", column)).drop("_new").select(*rows.columns)
