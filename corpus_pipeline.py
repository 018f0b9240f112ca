"""The corpus pipeline: each stage works on what the one before kept.

Stages are written as Parquet in the shared folder and read again, so a lost executor costs a
stage at most and the last stage, packing, reads files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tripspark.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from tripspark.llm.common import read, stored
from tripspark.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.passing(docs, read(spark, sf_dir, "labels"))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents share."""
    return line_dedup.without_shared_lines(docs)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_per_group(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontaminate.uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.packed(docs)


def shipped(stage: Stage) -> Stage:
    """The stage, with the package on the workers of its session."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", shipped(good_documents)),
    ("line_dedup", shipped(own_lines)),
    ("simhash_near_dedup", shipped(near_distinct)),
    ("decontamination", shipped(clean_documents)),
    ("packing", shipped(sequences)),
]

# The trees of the first stage cannot be expressed in SQL; tests hold the stages against brute
# force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
