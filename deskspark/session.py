"""Session settings, the shared work folder, and size checks."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings while tables are written: shuffle files go as soon as the statement that made them has ended, not when the driver
#: happens to collect its garbage, and rows go to the files of all their buckets at once instead of being sorted first.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "1024"}
_lean_lock = threading.Lock()
_lean_held: dict[int, tuple[int, dict]] = {}


def build_session(app: str = "deskspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and no web page; `conf` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local-mode session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    base = os.environ.get("DESKSPARK_LOCAL_DIR") or tempfile.mkdtemp(prefix="deskspark-")
    os.environ["DESKSPARK_LOCAL_DIR"] = base
    return base


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/deskspark/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def lean_on_disk(spark: SparkSession) -> Iterator[None]:
    """Set `LEAN` for a while. Threads and nested uses share it: the last one out puts back what was there."""
    with _lean_lock:
        holders, before = _lean_held.get(id(spark), (0, None))
        if before is None:
            before = {k: spark.conf.get(k, None) for k in LEAN}
            for k, v in LEAN.items():
                spark.conf.set(k, v)
        _lean_held[id(spark)] = holders + 1, before
    try:
        yield
    finally:
        with _lean_lock:
            holders, before = _lean_held.pop(id(spark))
            if holders > 1:
                _lean_held[id(spark)] = holders - 1, before
            else:
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a relation, known before anything runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcastable(df: DataFrame) -> bool:
    """Whether the estimate lies under the session's broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= estimated_bytes(df) <= limit


MEGABYTE = 1 << 20
SPREAD_FROM, SPREAD_UPTO = 4 * MEGABYTE, 128 * MEGABYTE


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Deal out a table of about one input split by its key before work is done on its rows.

    One task would otherwise do all lookups. A grouping by the same key needs no further shuffle.
    A larger table comes in many splits and is left alone, to be combined before its shuffle.
    """
    if not SPREAD_FROM <= estimated_bytes(rows) <= SPREAD_UPTO:
        return rows
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key)
