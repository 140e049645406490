"""Incremental upserts: each micro-batch is merged with what is there, by key, the newest row winning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.index import keep_first


def merge(prior: DataFrame, fresh: DataFrame, key: str, newest: str) -> DataFrame:
    """One row for each key; merging the same rows again changes nothing."""
    rows = prior.withColumn("_pos", F.lit(0)).unionByName(fresh.withColumn("_pos", F.lit(1)))
    return keep_first(rows, [key], [F.desc_nulls_last(newest), F.desc("_pos")]).drop("_pos")


def upsert_stream(source: DataFrame, target: str, key: str, newest: str, checkpoint: str) -> StreamingQuery:
    """Versions of the table are folders target/v=N; a batch writes its own and is idempotent when it is repeated."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch
        if number:
            prior = spark.read.schema(batch.schema).parquet(f"{target}/v={number - 1}")
            fresh = merge(prior, batch, key, newest)
        else:
            fresh = keep_first(batch, [key], [F.desc_nulls_last(newest)])
        fresh.write.mode("overwrite").parquet(f"{target}/v={number}")

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{target}/v={number}")


def windowed_counts(source: DataFrame, time: str = "ts", key: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by key and window of event time, with a watermark; the same on a stream and on a table."""
    return source.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("begins"), key, "n")
