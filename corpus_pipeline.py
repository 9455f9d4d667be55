"""Corpus pipeline over the documents table: language ID, near-dedup, substring dedup, decontamination, packing.

Every stage works on all that its predecessor kept. The first four return the
columns of documents; the last one the packing of what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lanewatch.llm.common import read, remove_dir, scratch_dir
from lanewatch.llm.decontam import decontaminate
from lanewatch.llm.langid import keep_identified
from lanewatch.llm.neardup import drop_near_duplicates
from lanewatch.llm.packing import pack, word_vocabulary
from lanewatch.llm.substring import remove_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, no letter) go."""
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest id stays."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that repeat anywhere are cut out; other documents stay as they are."""
    return remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; clean documents stay as they are."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequence and place."""
    return pack(docs, word_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", language_id),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Learned classifiers and tokenizer ids have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs, before = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        folder = scratch_dir(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove_dir(spark, before)
        before = folder
    return docs
