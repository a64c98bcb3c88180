"""Source snapshots that arrive as files, loaded batch by batch as they come."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from deskspark.functions.clock import utc_now
from deskspark.plans.entities import ENTITIES
from deskspark.plans.loader import FAIL, Loader
from deskspark.plans.spec import EntitySpec
from deskspark.sources.store import TableStore


def batch_version(stream: str, batch_id: int) -> str:
    return f"batch-{stream}-{batch_id:012d}"


def stream_id(session: SparkSession) -> str:
    """The id that a stream keeps in its checkpoint; a new checkpoint is a new stream."""
    return session.sparkContext.getLocalProperty("sql.streaming.queryId")


def load_arrivals(stream: DataFrame, name: str, source: Callable[[SparkSession], Mapping[str, DataFrame]],
                  store: TableStore,
                  checkpoint: str, run_ts: datetime | Callable[[], datetime] = utc_now,
                  on_violation: str = FAIL, specs: Mapping[str, EntitySpec] = ENTITIES,
                  trigger: Mapping | None = None) -> StreamingQuery:
    """Upsert each micro-batch of `stream` (source rows of `name`) into the store.

    Every version hands on the last batch of each stream, so a batch that is replayed after its
    publish is recognised and left alone, also if another stream or a daily run published since;
    one that failed before it is written again from the start.
    `source` supplies the parents within the session that Spark hands to the batch.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream_key, pointer = stream_id(session), store.pointer(name) or {}
        if pointer.get("streams", {}).get(stream_key, -1) >= batch_id:
            return
        now = run_ts() if callable(run_ts) else run_ts
        parents = source(session)
        tables = {**{lk.parent: parents[lk.parent] for lk in specs[name].lookups}, name: batch}
        Loader(session, tables, TableStore(session, store.root), now, on_violation, specs,
               bucketed=[name] if pointer.get("buckets") else []).load(
            name, batch_version(stream_key, batch_id), {stream_key: batch_id})

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
