"""Snapshots of loaded tables, one folder per run date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskspark.sources.files import read_file, write_file

RUN_DATE = "run_date"


class History:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def append(self, name: str, df: DataFrame, run_date: date) -> None:
        """Add the snapshot of a run date; a second run of that date replaces only its own."""
        write_file(df, f"{self.root}/{name}/{RUN_DATE}={run_date.isoformat()}", self.fmt, mode="overwrite")

    def run_dates(self, name: str) -> list[date]:
        """Dates with a finished snapshot, from the folder names."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.root}/{name}")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        folders = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith(f"{RUN_DATE}=")]
        done = [f for f in folders if fs.exists(hadoop.Path(f, "_SUCCESS"))]
        return sorted(date.fromisoformat(f.getName().split("=", 1)[1]) for f in done)

    def as_of(self, name: str, schema: T.StructType, day: date) -> DataFrame:
        """The latest snapshot taken on or before `day`, with its date; reads that folder only."""
        earlier = [d for d in self.run_dates(name) if d <= day]
        if not earlier:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(RUN_DATE, T.DateType())]))
        path = f"{self.root}/{name}/{RUN_DATE}={earlier[-1].isoformat()}"
        df = read_file(self.spark, path, schema, self.fmt, audited=self.fmt == "csv")  # its headers are checked while reading
        return df.withColumn(RUN_DATE, F.lit(earlier[-1]))
