"""From raw documents to a training mix: toxicity, line dedup, near-dedup, decontamination, mixing.

Each stage takes what its predecessor kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkprep.llm import decontaminate, line_dedup, mixing, near_dedup, toxicity
from sparkprep.llm.frames import table
from sparkprep.session import materialise


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows are cut; documents that lose every line go."""
    return line_dedup.drop_repeated_lines(docs, drop_emptied=True)


def near_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: sorted by ``mix_slot`` and ``mix_place`` the rows follow the target weights."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxic_filter),
    ("line_dedup", line_filter),
    ("near_dedup", near_filter),
    ("decontaminate", benchmark_filter),
    ("mix", mix_sources),
]

#: Nearest examples, signatures and the latent space can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
