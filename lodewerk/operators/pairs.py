"""All pairs of rows with one key, as a report that lists them must: neither shuffled nor held.

Rows are packed into blocks of about ``BLOCK`` rows of a key; blocks meet by key
and pairs of blocks are dealt out to tasks, which write the pairs of their rows
one after another.  What is shuffled are rows and pairs of blocks, so it grows
with the rows and with one ``BLOCK``th of the pairs; a hot key is many blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512


def spread(df: DataFrame, *columns: str, waves: int = 4) -> DataFrame:
    """The rows over all cores, some tasks each, however few bytes they are: for steps that make much of a row."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), waves * spark.sparkContext.defaultParallelism), *columns)


def blocks(rows: DataFrame, key: str, side: str, *kept: str) -> DataFrame:
    """(key, side, part, rows): distinct rows with a key in blocks by key and side; ``rows`` are structs of what is kept."""
    held = rows.filter(F.col(key).isNotNull()).select(key, side, *kept).distinct()
    n = held.groupBy(key, side).agg(F.count("*").alias("_n"))
    placed = held.join(n, [key, side]).withColumn("part", F.pmod(F.xxhash64(*kept), F.ceil(F.col("_n") / BLOCK)))
    return placed.groupBy(key, side, "part").agg(F.collect_list(F.struct(*kept)).alias("rows"))  # BLOCK rows or so


def of_blocks(left: DataFrame, right: DataFrame, key: str, meet: Column, *kept: str) -> DataFrame:
    """(key, x_side, y_side, x_ and y_ columns): the pairs of rows of all blocks that have one key and meet, by their sides x_side and y_side."""
    x = left.select(key, F.col("side").alias("x_side"), F.col("part").alias("x_part"), F.col("rows").alias("_x"))
    y = right.select(key, F.col("side").alias("y_side"), F.col("part").alias("y_part"), F.col("rows").alias("_y"))
    dealt = spread(x.join(y, key).filter(meet), key, "x_side", "x_part", "y_side", "y_part")
    first = dealt.select(key, "x_side", "y_side", "_y", F.inline("_x")).withColumnsRenamed({c: f"x_{c}" for c in kept})
    return first.select(key, "x_side", "y_side", *(f"x_{c}" for c in kept), F.inline("_y")).withColumnsRenamed({c: f"y_{c}" for c in kept})
