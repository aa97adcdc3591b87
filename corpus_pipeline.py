"""The corpus pipeline: five stages over ``documents``, each by one corpus operator.

Each stage works on all that its predecessor kept, is written as Parquet in the
shared folder and read again. SQL cannot express the language model or the random
rounding, so there is no ORACLE_SQL; the tests hold the stages against brute force.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from tidyload.llm import decontaminate, language_id, minhash, mixing, suffix_dedup
from tidyload.llm.common import small_batches, table, written

MIN_BYTES = 100
"""Repeated strings from this many bytes on go: well under a passage of 50 words,
and over the stock lines and phrases that ordinary documents share."""


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose letters less than a quarter are in words known to a learned language go."""
    return language_id.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays, whatever their ids."""
    return minhash.keep_one_row_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents stay in the first one only."""
    return suffix_dedup.without_repeats(docs, min_bytes=MIN_BYTES)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken so that sources meet their target weights."""
    return mixing.mix(docs)


STAGES = [("language", language), ("minhash", near_duplicates), ("substrings", substrings),
          ("benchmark", benchmark), ("mixing", mixture)]
PACKING = {"substrings"}
"""Stages that pack the texts of a batch by block: their batches keep the session's size."""
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with nullcontext() if name in PACKING else small_batches(spark):
            docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
