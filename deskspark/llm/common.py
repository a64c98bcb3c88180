"""Helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskspark.session import shared_folder

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

#: What separates words: the space and the ASCII control characters tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: Rows that Spark hands a Python worker at a time, and the session's setting for it.
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches have at most BATCH_ROWS rows; a smaller setting stays.

    Of whole texts Spark's 10,000 are tens of MB, which the JVM and every Python worker hold several times over
    and keep in their pools. Frames are run after the function that made them, so the setting is not taken back.
    """
    now = int(spark.conf.get(BATCH_SETTING))
    if now <= 0 or now > BATCH_ROWS:  # none and negative numbers mean no limit
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def giving_back(run: Batches) -> Batches:
    """`run`, after which the worker, which Spark keeps for later tasks, returns what Arrow's pool holds unused."""

    @wraps(run)
    def run_and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return run_and_release


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the folder that the cluster shares."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


class Staged:
    """A Parquet copy of a frame in the shared folder; `drop` removes it."""

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(conf).delete(path, True)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """A Parquet copy in the shared folder in as many buckets by `key` as there are shuffle partitions; joins on it by the key move only the other side."""
    name, width = f"{label}_{uuid.uuid4().hex[:12]}", shuffle_width(df.sparkSession)
    path = f"{shared_folder(df.sparkSession)}/llm/{name}"
    df.repartition(width, key).write.format("parquet").option("path", path).bucketBy(width, key).saveAsTable(name)
    return df.sparkSession.table(name)


def id_fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for NULL or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def unused(name: str, columns: list[str]) -> str:
    """`name`, lengthened until no column is called so (Spark's names ignore case)."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
