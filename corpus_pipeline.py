"""The corpus pipeline: documents go through STAGES, each written as Parquet and read again by the next.

``run`` returns what the last stage returns.  ORACLE_SQL is None: SQL cannot express the learned quality rules, the
bootstrapped extraction or the packing; tests/llm compares the stages with brute force.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from salesforge.llm import line_dedup, near_dedup, packing, pii, quality_rules
from salesforge.llm.common import materialize, read_table, ship_package
from salesforge.session import delete_path, ensure_checkpoint_dir


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(f: Stage) -> Stage:
    """A stage by itself: its workers get the library, whoever made the session."""
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, docs, sf_dir)

    return run_stage


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the base rules or the learned list reject go."""
    return quality_rules.filter_documents(docs, quality_rules.fit(docs, read_table(spark, sf_dir, "labels")))


@stage
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: later copies of repeated line runs are cut out; a document of which nothing is left goes."""
    return line_dedup.remove_repeated_runs(docs, chars_col="n_chars")


@stage
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of near-duplicates the document with the smallest id stays."""
    return near_dedup.keep_one(docs)


@stage
def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: personal data is replaced by its kind."""
    return pii.mask(docs, chars_col="n_chars")


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the pieces of all documents with their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("personal data", pii_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    try:
        for k, (_, f) in enumerate(STAGES[:-1]):
            f(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                delete_path(spark, f"{folder}/{k - 1}")  # a stage reads its predecessor's table only
        return materialize(STAGES[-1][1](spark, docs, sf_dir))
    finally:
        delete_path(spark, folder)
