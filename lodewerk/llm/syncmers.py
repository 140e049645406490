"""Document fingerprints of closed syncmers over words.

A k-mer of ``K`` words is chosen if the least hash among its runs of ``S``
words stands at its begin or its end (ties count).  That depends on the k-mer
alone, so a passage gives the same anchors in any document: about 2 of every
``K - S + 1`` positions, and one at least in every ``K - S`` consecutive ones.

Results by case: null and empty texts and texts of fewer than ``k`` words have
empty fingerprints, rows without an id too have their row; repeated rows give
equal rows; an empty table gives no rows.  Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textarrays as ta

K, S = 16, 4


def anchors(words: ta.Words, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Where the closed syncmers of all rows begin, and their hashes."""
    hashes = words.hashes()
    inner = ta.window_hashes(hashes, s)
    least = ta.sliding_min(inner, k - s + 1)
    at = np.arange(len(least))
    chosen = at[((least == inner[at]) | (least == inner[at + k - s])) & (at + k <= words.first[words.row[at] + 1])]
    return chosen, ta.window_hashes(hashes, k)[chosen]


def fingerprints(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """(doc_id, words, positions, hashes) of every document. One scan, no shuffle."""
    if not 0 < s <= k:
        raise ValueError("0 < s <= k")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, words in ta.words_of(batch.column(1)):
                n = len(words.counts)
                at, hashes = anchors(words, k, s)
                row = words.row[at]
                offsets = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
                places = pa.ListArray.from_arrays(offsets, pa.array((at - words.first[row]).astype(np.int32)))
                values = pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), ta.ints(words.counts), places, values], ["doc_id", "words", "positions", "hashes"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, "doc_id bigint, words bigint, positions array<int>, hashes array<bigint>")


def match(left: DataFrame, right: DataFrame, least: int = 2) -> DataFrame:
    """(left_id, right_id, shift, anchors): for each pair of documents the shift on which most anchors agree, ``least`` or more.

    The pair's passages lie ``shift`` words further on in the right document;
    of several shifts with as many anchors the least counts.  Documents without
    an id match nothing.
    """

    def exploded(prints: DataFrame, name: str) -> DataFrame:
        pairs = prints.filter("doc_id is not null").select("doc_id", F.explode(F.arrays_zip("positions", "hashes")).alias("x"))
        return pairs.select(F.col("doc_id").alias(f"{name}_id"), F.col("x.positions").alias(f"{name}_at"), F.col("x.hashes").alias("hash"))

    votes = exploded(left, "left").join(exploded(right, "right"), "hash").groupBy("left_id", "right_id", (F.col("right_at") - F.col("left_at")).alias("shift")).agg(F.count("*").alias("anchors")).filter(F.col("anchors") >= least)
    first = Window.partitionBy("left_id", "right_id").orderBy(F.desc("anchors"), "shift")
    return votes.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(ta.documents(spark, sf_dir))
