"""Names that imitate popular ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E

THRESHOLD = 0.80


EDITS = 2


def _start(n: Column, i: int) -> Column:
    """Where the i-th of EDITS + 1 segments of n letters begins, from 1."""
    return F.floor(n * i / (EDITS + 1)).cast("int") + 1


def _key(n: Column, i: int, text: Column) -> Column:
    return F.concat_ws(":", n.cast("string"), F.lit(str(i)), text)


def segment_keys(text: Column) -> Column:
    """The segments of a name, with its length: at most two edits leave one of three as it is."""
    n = F.length(text)
    return F.array(*(_key(n, i, F.substring(text, _start(n, i), _start(n, i + 1) - _start(n, i))) for i in range(EDITS + 1)))


def probe_keys(text: Column) -> Column:
    """What the segments of a name with two letters more or fewer could be in this one: two places before or behind at most."""
    lengths = F.sequence(F.greatest(F.length(text) - EDITS, F.lit(0)), F.length(text) + EDITS)

    def of(n: Column) -> Column:
        keys = []
        for i in range(EDITS + 1):
            size = _start(n, i + 1) - _start(n, i)
            for shift in range(-EDITS, EDITS + 1):
                at = _start(n, i) + shift
                keys.append(F.when((at >= 1) & (at + size - 1 <= F.length(text)), _key(n, i, F.substring(text, at, size))))
        return F.array_compact(F.array(*keys))

    return F.array_distinct(F.flatten(F.transform(lengths, of)))


def best_matches(names: DataFrame, popular: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """For each (ecosystem, name) the popular name of the ecosystem that is most alike, the more popular one on ties.

    Names that are two edits apart at most have a third of the popular one in
    common, at about the same place, and meet by that; additions, scopes and
    look-alikes have keys of their own.  So rows grow with the names and not with
    the pairs of a length.
    """
    a = names.select("ecosystem", "name", F.lower("name").alias("a"))
    b = popular.select("ecosystem", F.col("name").alias("target"), F.lower("name").alias("b"), "weekly")
    edits = a.select("*", F.explode(probe_keys(F.col("a"))).alias("k")).join(b.select("*", F.explode(segment_keys(F.col("b"))).alias("k")), ["ecosystem", "k"]).drop("k").filter(F.levenshtein("a", "b", EDITS) >= 0)

    def keys(text):
        """A name, and every part of it before or after a separator."""
        spots = F.sequence(F.lit(1), F.length(text))
        heads = F.transform(F.filter(spots, lambda i: F.substring(text, i, F.lit(1)).isin("-", "_", ".")), lambda i: F.substring(text, F.lit(1), i - 1))
        tails = F.transform(F.filter(spots, lambda i: F.substring(text, i, F.lit(1)).isin("-", "_", ".")), lambda i: F.substring(text, i + 1, F.length(text)))
        return F.array_distinct(F.concat(F.array(text, E.fold(text), E.strip_scope(text)), heads, tails))

    keyed = a.select("*", F.explode(keys(F.col("a"))).alias("k")).join(b.select("*", F.explode(keys(F.col("b"))).alias("k")), ["ecosystem", "k"]).drop("k")
    pairs = edits.unionByName(keyed).filter("a <> b").distinct().withColumn("m", E.similarity(F.col("a"), F.col("b"))).filter(F.col("m.score") >= threshold)
    best = Window.partitionBy("ecosystem", "name").orderBy(F.desc("m.score"), F.desc("weekly"), "target")
    return pairs.withColumn("r", F.row_number().over(best)).filter("r = 1").select("ecosystem", "name", "target", "weekly", F.round("m.score", 6).alias("score"), F.col("m.technique").alias("technique"))
