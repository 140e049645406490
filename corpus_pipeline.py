"""From raw documents to packed windows: toxicity, near duplicates, repeated passages, benchmark passages, packing.

Every stage works on all that its predecessor kept.  Between stages the
documents are Parquet in the folder that the executors share; ``run`` removes
what a stage has read once its result is written, so two stages' rows are there
at most, and the last stage's input stays for whoever reads the result.

Results by case: rows with a null id or text pass the first stages unchanged
(toxicity and benchmark go by the text, near and repeated passages need both)
and have no place in a window; empty texts are one group of near duplicates, of
which one stays, without a place; repeated rows (equal id and text) stay or go
together; very long texts are cut into windows; an empty table gives no rows;
columns beside those of documents are kept up to the packing, whatever their
names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodewerk.llm import bm25pack, decontaminate, orderminhash, suffixdedup, toxicity
from lodewerk.operators.components import drop, shared_folder


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go, by the word list and the stems that the labels teach."""
    return toxicity.reject(docs, stems=toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of least id."""
    return orderminhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stood in an earlier document go."""
    return suffixdedup.remove(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in windows."""
    return bm25pack.windows(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("packing", packing),
]
ORACLE_SQL: str | None = None  # SQL can't express the stages; tests compare them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    read = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if read:
            drop(spark, read)
        read = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
