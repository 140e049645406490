"""Rows in shards of bounded size, numbered without one task seeing them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import cut

LIMIT = 45 << 20


def size_bounded(rows: DataFrame, keys: list[str], order: list[str], text: str, limit: int = LIMIT) -> DataFrame:
    """Rows with ``shard``: within the keys, in order, a new number whenever the bytes of the texts (with a line end each) before a row fill another ``limit``.

    Range partitions add up their own rows and what stands before them, so a
    key that holds most rows is spread over tasks like any other.  Null texts
    count as empty; ties in order need a further column.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    parts = cut(rows.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()).withColumn("_size", size))
    sums = parts.groupBy(*keys, "_part").agg(F.sum("_size").alias("_sum"))  # a row for each part of a key
    ahead = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(inside), F.lit(0)) + F.col("_ahead")
    return parts.join(ahead, [*keys, "_part"]).withColumn("shard", F.floor(before / limit).cast("bigint")).drop("_part", "_size", "_ahead")
