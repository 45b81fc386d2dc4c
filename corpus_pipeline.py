"""The corpus pipeline: toxicity, line dedup, MinHash near-dedup, benchmark decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
in the shared folder and read back as the next stage's ``docs``. All stages but the last
return the columns of documents. Part of the ``llm`` subpackage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from glossa.llm import decontaminate, near_dedup, packing, templates, toxicity  # noqa: E402
from glossa.llm.common import stored, table  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under one half stay."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first; so do documents of nothing else."""
    return templates.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.survivors(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_recurring_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL cannot train the network or tokenise; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
