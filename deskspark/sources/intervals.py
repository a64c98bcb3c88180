"""History as validity intervals: a row is kept once for as long as it stays the same.

Every run's snapshot is compared with the rows that are still valid. Rows that are gone or changed are
closed under the run's date, new ones are opened. Closed rows never change again: each run adds a
folder of its own for them, so what a run writes is as large as the snapshot, not as the history. The
pointer names the open rows' version and the closed folders by date, and is published last, so a run
that fails leaves the history as it was.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskspark.sources.store import TableStore

COPIES, FROM, TO = "n_copies", "valid_from", "valid_to"


def with_interval(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(COPIES, T.LongType()), T.StructField(FROM, T.DateType()), T.StructField(TO, T.DateType())])


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number; combined before the shuffle, so many copies are no burden."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COPIES))


def differences(valid: DataFrame, snapshot: DataFrame, columns: list[str], day: date) -> DataFrame:
    """`valid` (open rows with intervals) after a snapshot (counted rows): kept, closed and opened rows.

    Rows are compared in all columns, NULLs equal, and in their number of copies, so rows without a key
    need no rule of their own.
    """
    every = [*columns, COPIES]
    print_ = F.xxhash64(*every)
    old = valid.select(F.struct(*every).alias("o"), FROM, print_.alias("h"), F.lit(True).alias("was"))
    new = snapshot.select(F.struct(*every).alias("s"), print_.alias("g"), F.lit(True).alias("is"))
    both = old.join(new, (F.col("h") == F.col("g")) & F.col("o").eqNullSafe(F.col("s")), "full_outer")
    row = F.coalesce("o", "s")
    return both.select(
        *[row[c].alias(c) for c in every],
        F.when(F.col("was"), F.col(FROM)).otherwise(F.lit(day)).alias(FROM),
        F.when(F.col("is").isNull(), F.lit(day)).alias(TO))


class IntervalHistory:
    """Takes the place of `History` in a `Loader`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store = spark, TableStore(spark, root)

    def append(self, name: str, df: DataFrame, run_date: date) -> None:
        """Add the snapshot of a run date. A second run of the last date replaces the first; an earlier
        date than the last is refused, as later intervals rest on it."""
        entry = self.store.pointer(name) or {}
        last, closed = entry.get("run_date"), dict(entry.get("closed", {}))
        day = run_date.isoformat()
        if last and day < last:
            raise ValueError(f"{name}: {day} is before the last run date {last}")
        schema = with_interval(df.schema)
        valid = self.store.current(name, schema)
        if last == day:  # as it was before the first run of this date
            again = self._closed(name, [closed.pop(day)], schema) if day in closed else self.spark.createDataFrame([], schema)
            valid = valid.filter(F.col(FROM) < F.lit(run_date)).unionByName(again.withColumn(TO, F.lit(None).cast("date")))
        after = self.store.stage(f"history_{name}", differences(valid, counted(df), df.columns, run_date))
        version = self.store.write(name, after.filter(f"{TO} IS NULL"))
        gone = after.filter(f"{TO} IS NOT NULL")
        if not gone.isEmpty():
            closed[day] = self.store.write(name, gone)
        self.store.publish(name, version, expected=entry.get("version"), run_date=day, closed=closed, also=sorted(closed.values()))

    def intervals(self, name: str, schema: T.StructType) -> DataFrame:
        """All rows that were ever valid, with `n_copies`, `valid_from` and `valid_to` (NULL: still valid)."""
        return self._since(name, with_interval(schema), date.min)

    def as_of(self, name: str, schema: T.StructType, day: date) -> DataFrame:
        """The rows valid on a day, as the last snapshot on or before it had them. Folders closed by then are not read."""
        rows = self._since(name, with_interval(schema), day).filter(F.col(FROM) <= F.lit(day))
        several = rows.filter(f"{COPIES} > 1").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(COPIES))))
        return rows.filter(f"{COPIES} = 1").select(*schema.names).unionByName(several.select(*schema.names))

    def _since(self, name: str, schema: T.StructType, day: date) -> DataFrame:
        """The rows that were valid after `day` began or came later."""
        entry = self.store.pointer(name) or {}
        late = [v for closed, v in entry.get("closed", {}).items() if closed > day.isoformat()]
        return self.store.current(name, schema).unionByName(self._closed(name, late, schema))

    def _closed(self, name: str, versions: list[str], schema: T.StructType) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(self.store.folder(name, v) for v in versions))
