"""Connected components of an edge table, and the folder in which lineage is cut."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BLOCK = 4096  # ids next to each other whose edges one task contracts
CHUNK = 1 << 20  # edges that a task holds at once; a graph of so many is solved by one task
SMALL = 1 << 18  # edges whose components are sent to all tasks, 8 MB at most


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of our own only in local mode, where it is unset (tests)."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="lodewerk-")
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def drop(spark: SparkSession, path: str) -> None:
    """Removes a folder of intermediate rows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder: they survive the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def contraction(chunk: int = CHUNK):
    """A scan of Arrow batches that replaces each chunk of edges (u, v) by stars (u, v): a row for each vertex with the least of its component within the chunk; the least has itself.

    It is made of inner functions, so that tasks needn't import this package.
    """

    def least_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every root takes its least neighbour for its root, then paths are halved to nothing: two rounds leave half of a component's roots at most."""
        ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = np.arange(len(ids))
        a, b = at[: len(u)], at[len(u) :]
        while len(a):
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root = up
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
        return ids, ids[root]

    def stars(held: list) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in least_of(rows.column(0).to_numpy(), rows.column(1).to_numpy())], ["u", "v"])

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while n + batch.num_rows > chunk:
                held.append(batch.slice(0, chunk - n))
                batch = batch.slice(chunk - n)
                yield stars(held)
                held, n = [], 0
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if held:
            yield stars(held)

    return contract


def connected_components(edges: DataFrame, max_rounds: int = 100, chunk: int = CHUNK) -> DataFrame:
    """(id, component) for every vertex of edges (src, dst); the component is its least id.

    Edges of integers meet by blocks of neighbouring ids, where each task
    replaces them by stars, a row for each vertex however many edges there are.
    A vertex in one star only follows the star's centre; the edges between
    centres, and from vertices in several stars, remain to be solved, by one
    task if there are no more than it holds, else by rounds.  Ids without any
    locality leave more to the rounds, with the same result.

    Null ends, loops and repeated edges are ignored; an edge table without any
    other edge gives no rows.
    """
    edges = edges.filter("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    kind = edges.schema["u"].dataType
    if not isinstance(kind, IntegralType):
        return _by_rounds(edges, max_rounds)
    edges = edges.select(F.col("u").cast("bigint"), F.col("v").cast("bigint"))
    # near ids meet in the block of the lesser, others in that of the greater, so that a centre with edges to all is no task of its own
    low, high = F.floor(F.col("v") / BLOCK), F.floor(F.col("u") / BLOCK)
    placed = edges.withColumn("block", F.when(high - low <= 1, low).otherwise(high)).repartition("block").sortWithinPartitions("block")
    stars = placed.select("u", "v").mapInArrow(contraction(chunk), "u bigint, v bigint")
    of = Window.partitionBy("u").orderBy("v")
    stars = stars.select("u", "v", F.first("v").over(of).alias("m"), F.row_number().over(of).alias("nth"), (F.max("v").over(Window.partitionBy("u")) == F.col("u")).alias("centre"))
    stars = cut(stars.filter("nth = 1 or v <> m and v <> u"))
    vertices = stars.filter("nth = 1").select(F.col("u").alias("id"), F.col("m").alias("component"))
    rest = stars.filter("nth = 1 and centre and m <> u").select("u", F.col("m").alias("v")).unionByName(stars.filter("nth > 1").select(F.col("v").alias("u"), F.col("m").alias("v")))
    n = rest.count()
    if n:
        if n <= chunk:
            solved = cut(rest.repartition(1).mapInArrow(contraction(chunk), "u bigint, v bigint")).select(F.col("u").alias("component"), F.col("v").alias("least"))
        else:
            solved = _by_rounds(rest, max_rounds).select(F.col("id").alias("component"), F.col("component").alias("least"))
        vertices = vertices.join(F.broadcast(solved) if n <= SMALL else solved, "component", "left").select("id", F.coalesce("least", "component").alias("component"))
    return vertices.select(F.col("id").cast(kind), F.col("component").cast(kind))


def _by_rounds(edges: DataFrame, max_rounds: int) -> DataFrame:
    """(id, component) of edges (u, v), u > v: alternates large-star and small-star steps, so rounds grow with the logarithm of the diameter."""
    edges = cut(edges.distinct())

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = cut(small.distinct())
        after = mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
