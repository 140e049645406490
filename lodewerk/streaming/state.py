"""State between runs: cursors by module, tokens by source, caches that expire, look-ups saved as they go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import gates as G
from ..operators.index import keep_first

EPOCH = "1970-01-01T00:00:00Z"


def since(modules: DataFrame, cursors: DataFrame, override: str | None = None) -> DataFrame:
    """(module, since): what is given, else the module's own cursor, else the epoch; no module takes over another's."""
    if override:
        return modules.select("module", F.lit(override).alias("since"))
    return modules.join(cursors.select("module", "cursor"), "module", "left").select("module", F.coalesce("cursor", F.lit(EPOCH)).alias("since"))


def commit(cursors: DataFrame, runs: DataFrame, started: str, override: str | None = None) -> DataFrame:
    """The cursors after runs (module, persisted, errors): a module moves on to the run's start if its rows are safe, no fetch failed, and the start wasn't given by hand."""
    done = runs.filter("persisted and errors = 0").select("module", F.lit(started).alias("cursor"))
    fresh = done.limit(0) if override else done
    both = cursors.select("module", "cursor").withColumn("_at", F.lit(1)).unionByName(fresh.withColumn("_at", F.lit(0)))
    return keep_first(both, ["module"], ["_at"]).drop("_at")


def merge_tokens(stored: DataFrame, new: DataFrame) -> DataFrame:
    """(source, sequence, etag, commit, seen): the newest token of each kind; what a run doesn't say stays, sequences only grow."""
    both = stored.withColumn("_at", F.lit(0)).unionByName(new.withColumn("_at", F.lit(1)))
    last = [F.expr(f"max_by({c}, _at) filter (where {c} is not null)").alias(c) for c in ("etag", "commit")]
    return both.groupBy("source").agg(F.max("sequence").alias("sequence"), *last, F.max("seen").alias("seen"))


def expire(cache: DataFrame, now: Column, days: int) -> DataFrame:
    """The entries that are still fresh."""
    return cache.filter(G.fresh(F.col("fetched"), now, days))


def look_up_stream(wanted: DataFrame, cache: str, look_up: Callable[[DataFrame], DataFrame], checkpoint: str, keys: tuple[str, ...] = ("type", "value")) -> StreamingQuery:
    """Look-ups of a stream of keys, saved after each micro-batch: what was found before a failure isn't looked up again, and a repeated batch overwrites its own part."""

    def save(batch: DataFrame, number: int) -> None:
        look_up(batch.select(*keys).distinct()).write.mode("overwrite").parquet(f"{cache}/batch={number}")

    return wanted.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
