"""Outputs: JSON lines by module, plain lists, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import shards
from ..operators.components import cut


def write_modules(incidents: DataFrame, path: str, files: int = 1) -> None:
    """JSON lines in a folder for each module, ordered by id; a rerun replaces only the modules it has."""
    ordered = incidents.repartition(files, "module").sortWithinPartitions("module", "id")
    ordered.write.partitionBy("module").option("partitionOverwriteMode", "dynamic").mode("overwrite").json(path)


def write_lines(values: DataFrame, column: str, path: str) -> None:
    """The distinct values in byte order, one on a line."""
    values.select(F.col(column).cast("string").alias("value")).filter("value <> ''").distinct().repartitionByRange("value").sortWithinPartitions("value").write.mode("overwrite").text(path)


def manifest(spark, path: str) -> DataFrame:
    """(path, bytes, sha256) of every file under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def line_counts(spark, path: str) -> DataFrame:
    """(path, lines) that aren't blank, by file."""
    text = spark.read.option("recursiveFileLookup", True).text(path)
    return text.filter(F.trim("value") != "").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("lines"))


def write_shards(rows: DataFrame, path: str, keys: list[str], order: list[str], line: str, limit: int = shards.LIMIT) -> DataFrame:
    """Lines in folders by key and shard, each of at most about ``limit`` bytes and in order; shards of a former run that no row belongs to any more are gone. Gives (keys, shard, rows, bytes)."""
    named = shards.size_bounded(rows.select(*keys, *order, F.col(line).alias("value")), keys, order, "value", limit)
    parts = [*keys, "shard"]
    ordered = named.repartition(*[F.col(c) for c in parts]).sortWithinPartitions(*parts, *order)
    counts = cut(named.groupBy(*parts).agg(F.count("*").alias("rows"), F.sum(F.octet_length("value") + 1).alias("bytes")))
    ordered.select(*parts, "value").write.partitionBy(*parts).mode("overwrite").text(path)
    return counts


def write_document(rows: DataFrame, path: str, **parts: DataFrame) -> None:
    """One JSON document: a list for each part in the order it comes in. For indexes of a bounded listing; the rows' own columns are its head."""
    head = rows.select(F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("head"))
    for name, part in parts.items():
        lists = part.select(F.to_json(F.struct(*[F.col(c) for c in part.columns])).alias("_j")).agg(F.array_join(F.collect_list("_j"), ",").alias("_l"))  # a bounded listing
        head = head.join(F.broadcast(lists)).select(F.concat(F.expr("substring(head, 1, length(head) - 1)"), F.lit(f',"{name}":['), F.coalesce("_l", F.lit("")), F.lit("]}")).alias("head"))
    head.select(F.col("head").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_if_changed(rows: DataFrame, path: str, key: str, digest: str = "hash") -> int:
    """Writes the rows if any of their (key, digest) isn't what is there, or one is gone; gives how many differ, 0 meaning that nothing was written."""
    spark = rows.sparkSession
    mine = rows.select(key, digest)
    there = _existing(spark, path)
    if there is not None:
        old = there.select(key, digest)
        differ = mine.exceptAll(old).count() + old.exceptAll(mine).count()
        if not differ:
            return 0
    else:
        differ = mine.count()
    kept = cut(rows)  # the source may be what is overwritten
    kept.write.mode("overwrite").parquet(path)
    return differ


def write_drafts(drafts: DataFrame, path: str) -> int:
    """Drafts by year of ``published`` ("unknown" without one), as JSON lines; those whose id is there already are never written again. Gives how many are new."""
    spark = drafts.sparkSession
    there = _existing(spark, path, "json", "id string, year string")
    fresh = drafts.withColumn("year", F.coalesce(F.date_format("published", "yyyy"), F.lit("unknown")))
    if there is not None:
        fresh = fresh.join(there.select("id").distinct(), "id", "left_anti")
    fresh = cut(fresh)
    n = fresh.count()
    if n:
        fresh.write.partitionBy("year").mode("append").json(path)
    return n


def stale_files(spark: SparkSession, path: str, before: str, pattern: str = "*.yaml") -> DataFrame:
    """(path, modified) of files in a folder and the one below it that were last changed before a time; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    root = len([p for p in path.rstrip("/").split("/") if p])
    depth = F.size(F.filter(F.split(F.regexp_replace("path", "^file:", ""), "/"), lambda p: p != ""))
    return files.filter((F.col("modificationTime") < F.lit(before).cast("timestamp")) & (depth <= root + 2)).select("path", F.col("modificationTime").alias("modified"))


def _existing(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None) -> DataFrame | None:
    """What stands at a path, or nothing."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(kind).load(path)
