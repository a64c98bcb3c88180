"""From documents to packed training sequences, stage by stage.

Every stage works on all rows that the stage before kept and is written as Parquet to the shared
folder before the next one reads it. All stages but the last return the columns of `documents`. Texts
go to Python in short batches, a setting that the session keeps.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskspark.llm import contamination, ngram_join, packing, quality_model, secret_scan
from deskspark.llm.common import Staged, short_batches, table
from deskspark.llm.queries import training_labels

THRESHOLD = 0.3
NEAR = ngram_join.Law(words=5, percent=80)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_short_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        short_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_short_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_model.fit(docs, training_labels(spark, sf_dir))
    return docs.filter(quality_model.score_of(F.col("text"), model) >= THRESHOLD)


@in_short_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of NEAR.words words that share NEAR.percent of their union."""
    return ngram_join.one_of_each(docs, NEAR)


@in_short_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return contamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@in_short_batches
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs, secret_scan.scan(docs))


@in_short_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("secrets", secrets), ("packing", packed),
]
#: No stage's model or placement can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Staged(stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
