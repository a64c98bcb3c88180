"""Load entities in dependency order, each published whole or not at all."""

from __future__ import annotations

import logging
import threading
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deskspark.functions.clock import utc_now
from deskspark.functions.keys import BINARY
from deskspark.operators import checks
from deskspark.operators.resolve import (
    far_lookups, kept, keys_found_again, link, rejects, repeated_ids, resolve, resolve_in_turn, survivors, unresolved,
    with_keys,
)
from deskspark.operators.surrogate import Ranges
from deskspark.operators.upsert import ACTION, BOOKKEEPING, COUNT, lacks_keys, merge
from deskspark.plans.entities import ENTITIES, load_levels
from deskspark.plans.spec import EntitySpec
from deskspark.session import broadcastable, lean_on_disk, spread
from deskspark.sources.history import History
from deskspark.sources.store import TableStore, bucket_of

log = logging.getLogger(__name__)

#: Compression of tables that no lookup reads. It is not used for parents: Spark plans broadcasts by the size of files,
#: and smaller files would make it send larger tables around.
CODEC = "zstd"

#: Larger tables are dealt out into buckets of about so many rows, written by columns, instead of being shuffled as rows.
ROWS_PER_BUCKET = 1 << 21
#: A key or id with which a bucket would hold more than so many times that is left to a shuffle, which combines or splits it.
CROWDED = 2
#: So many buckets are joined one after the other by a task that deals the rows out again, as each task writes a file a bucket.
BUCKETS_PER_TASK = 4

FAIL = "fail"
QUARANTINE = "quarantine"

REPORT_SCHEMA = (
    "entity string, status string, rows_read long, rejected long, quarantined long, "
    "inserted long, updated long, kept long"
)


@dataclass
class LoadReport:
    entity: str
    status: str = "loaded"
    rows_read: int | None = None
    rejected: int | None = None
    quarantined: int | None = None
    inserted: int | None = None
    updated: int | None = None
    kept: int | None = None


def codec_of(name: str, specs: Mapping[str, EntitySpec] = ENTITIES) -> str | None:
    """The compression of a table; None is the session's, for parents."""
    return None if any(lk.parent == name for spec in specs.values() for lk in spec.lookups) else CODEC


class LoadFailed(RuntimeError):
    """Some entities failed; `reports` says which, `errors` says why."""

    def __init__(self, errors: dict[str, Exception], reports: list[LoadReport]):
        super().__init__("; ".join(f"{n}: {e}" for n, e in errors.items()))
        self.errors, self.reports = errors, reports


class Loader:
    """Loads from `source` (name -> DataFrame) into `store`, all with one run time.

    The tables named in `bucketed` are kept bucketed by their key, in as many buckets as the session
    has shuffle partitions, so that the next run's merge shuffles the source once and the target
    not at all; rows whose keys fall into some buckets only read and rewrite these alone. A table with NULL keys stays plain, as all of them would fall into one bucket; so
    does one whose keys are not compared as they stand. With `keep_rejects` the rows that a required
    lookup dropped are written to `<entity>_rejects`; with a `history` each published table is
    added to it under the run's date. With `keep_unresolved` each version carries the codes of optional
    parents that were missing when its rows were loaded, and `repair` loads those rows again once the
    parents are there.
    """

    def __init__(self, spark: SparkSession, source: Mapping[str, DataFrame], store: TableStore,
                 run_ts: datetime | None = None, on_violation: str = FAIL,
                 specs: Mapping[str, EntitySpec] = ENTITIES, bucketed: Collection[str] = (),
                 keep_rejects: bool = False, history: History | None = None, keep_unresolved: bool = False):
        if on_violation not in (FAIL, QUARANTINE):
            raise ValueError(f"on_violation must be {FAIL!r} or {QUARANTINE!r}")
        self.spark, self.source, self.store, self.specs = spark, source, store, specs
        self.run_ts = run_ts or utc_now()
        self.on_violation = on_violation
        self.bucketed = frozenset(bucketed)
        self.keep_rejects, self.history, self.keep_unresolved = keep_rejects, history, keep_unresolved
        self._once = _OncePerKey()

    def current(self, name: str) -> DataFrame:
        return self.store.current(name, self.specs[name].target_schema)

    def load(self, name: str, version: str | None = None, streams: dict | None = None,
             rows: DataFrame | None = None) -> LoadReport:
        """Read, resolve, check, merge, write, then publish. Anything raised before the last
        step, the publish, leaves the published version as it was. `streams` adds to the last
        batches of streams, which every version hands on to the next. `rows` may hold some rows of
        the source, all of a key or none; the lists of rejects and quarantined rows then stay as they are."""
        dealt = _Dealt(self.store, name)
        try:
            with lean_on_disk(self.spark):
                return self._load(name, version, streams, rows, dealt)
        finally:
            dealt.drop()

    def _load(self, name: str, version: str | None, streams: dict | None, rows: DataFrame | None, dealt: "_Dealt") -> LoadReport:
        spec, some = self.specs[name], rows is not None
        before = self.store.pointer(name) or {}
        rows = rows if some else self._rows(name)
        report = LoadReport(name, rows_read=rows.count())
        log.info("%s: %d rows read", name, report.rows_read)
        parents = {lk.parent: self._parent(lk.parent) for lk in spec.lookups}
        ids = {p: table for p, (table, _) in parents.items()}
        links = {p: pair for p, (_, pair) in parents.items() if pair is not None}
        sources = {p: self._rows(p) for p in parents if p not in links}
        lookups = (spec, sources, ids, self.specs, links)

        report.quarantined = 0
        if spec.domain:
            report.quarantined = self._check_domain(rows, resolve(rows, *lookups), spec, not some)
        accepted = checks.within_domain(rows, spec) if spec.domain else rows
        null_keys = lacks_keys(rows, spec)
        target, touched, layout = self._layout(spec, before, accepted, null_keys)
        apart = None
        if some and not layout:
            target, apart = self._set_apart(spec, target, accepted)
        held = 0 if layout else self._row_count(spec, before) if apart is None else target.count()
        dealt.buckets = self._buckets_for(max(report.rows_read, held))
        if dealt.buckets and not any(self._crowded(accepted, lk.column, dealt.buckets, lk.required) for lk in far_lookups(spec, links)):
            resolved = resolve_in_turn(accepted, *lookups, dealt)
        else:
            resolved = resolve(spread(accepted, spec.key), *lookups)
        if dealt.buckets and not layout and spec.match == BINARY and not spec.scope and not any(
                self._crowded(side, spec.key, dealt.buckets) for side in (accepted, target)):
            resolved = dealt(name, resolved, spec.key)
            # Bucketed alike, the two are merged: Spark would broadcast millions of keys whose compressed files are small.
            target = dealt(f"target_{name}", target, spec.key).hint("merge")
            keys = None  # those of `resolved`, which are at hand now
        else:
            keys = survivors(accepted, *lookups) if spec.surrogate else None
        top = self._top_id(spec, before) if touched is not None or apart is not None else None
        ranges = Ranges.needed(report.rows_read, self.store.stage) if spec.surrogate else None
        merged = merge(target, resolved, spec, self.run_ts, keys, null_keys, not layout, top, ranges)
        if apart is not None:
            merged = merged.unionByName(apart.select(
                *spec.target_columns, F.lit("keep").alias(ACTION), F.lit(0).cast("long").alias(COUNT)))
        seen = Observation()
        count = lambda action: F.count(F.when(F.col(ACTION) == action, 1))
        merged = merged.observe(
            seen, count("insert").alias("inserted"), count("update").alias("updated"),
            count("keep").alias("kept"), F.coalesce(F.sum(COUNT), F.lit(0)).alias("merged"),
            F.max(spec.surrogate or F.lit(0)).cast("long").alias("top"),
        )
        merged = merged.drop(*BOOKKEEPING)
        codec = codec_of(name, self.specs)
        if touched is not None:
            if spec.scope:  # the merge grouped by key and scope, buckets go by the key
                merged = merged.repartition(before["buckets"], spec.key)
            version, layout = self.store.write_buckets(name, merged, before, touched, version, codec)
        else:
            if layout and (spec.scope or before.get("buckets") != layout["buckets"]):
                merged = merged.repartition(layout["buckets"], spec.key)
            version = self.store.write(name, merged, version, **layout, codec=codec)
        facts = seen.get
        report.inserted, report.updated, report.kept = (facts.get(k, 0) for k in ("inserted", "updated", "kept"))
        if touched is not None:
            report.kept = self._row_count(spec, before) - report.updated
        if any(self._repeats_ids(p) for p in parents):  # then more rows can be merged than were read
            report.rejected = report.rows_read - kept(rows, spec, {p: self._rows(p) for p in parents}, ids, self.specs).count()
        else:
            report.rejected = report.rows_read - report.quarantined - facts.get("merged", 0)
        numbers = {k: v for k, v in asdict(report).items() if k != "entity"}
        numbers["n_rows"] = report.inserted + report.updated + report.kept
        if spec.surrogate:
            numbers["top_id"] = max(top or 0, facts.get("top") or 0)
        if self.keep_rejects and not some and (report.rejected or self.store.pointer(f"{name}_rejects")):
            lost = rejects(rows, spec, {p: self._rows(p) for p in parents}, ids, self.specs)
            self.store.publish(f"{name}_rejects", self.store.write(f"{name}_rejects", lost))
        if self.history:
            whole = self.store.read(name, {"version": version, **layout}, spec.target_schema)
            self.history.append(name, whole, self.run_ts.date())
        waiting = self._still_waiting(spec, before, accepted, ids) if self.keep_unresolved else before.get("unresolved")
        beside = {"unresolved": waiting, "also": [waiting]} if waiting else {}
        unique_by = self._unique_by(spec, before)
        self.store.publish(name, version, expected=before.get("version"), **layout, **numbers, **beside, unique_by=unique_by,
                           streams={**before.get("streams", {}), **(streams or {})})
        self._once.forget(("parent", name))
        log.info("%s: %s", name, report)
        return report

    def unresolved(self, name: str) -> DataFrame:
        """(key, parent, code) that the rows of the published version wait for."""
        return self._unresolved(self.specs[name], self.store.pointer(name) or {})

    def repair(self, name: str) -> LoadReport | None:
        """Load those source rows again whose optional parents were missing and are there now; None if there are none.

        They go through the same load as ever, so the outcome for them is that of loading the whole
        source; of a bucketed table only their buckets are rewritten.
        """
        spec = self.specs[name]
        parents = {lk.parent: self.current(lk.parent) for lk in spec.lookups if not lk.required}
        keys = keys_found_again(self.unresolved(name), spec, parents, self.specs)
        rows = self.store.stage(f"repair_{name}", with_keys(self._rows(name), keys, spec))
        return None if rows.isEmpty() else self.load(name, rows=rows)

    def run_all(self) -> list[LoadReport]:
        """Level by level; the entities of a level run side by side. An entity whose parent did
        not load is skipped. Raises at the end if anything failed."""
        with lean_on_disk(self.spark):
            return self._run_levels()

    def _run_levels(self) -> list[LoadReport]:
        reports: dict[str, LoadReport] = {}
        errors: dict[str, Exception] = {}
        for level in load_levels(dict(self.specs)):
            ready = []
            for name in level:
                lost = {lk.parent for lk in self.specs[name].lookups} & {
                    n for n, r in reports.items() if r.status != "loaded"
                }
                if lost:
                    reports[name] = LoadReport(name, status="skipped")
                else:
                    ready.append(name)
            with ThreadPoolExecutor(max_workers=max(1, len(ready))) as pool:
                running = {name: pool.submit(self.load, name) for name in ready}
                for name, future in running.items():
                    try:
                        reports[name] = future.result()
                    except Exception as error:
                        log.error("%s: %s", name, error)
                        errors[name] = error
                        reports[name] = LoadReport(name, status="failed")
        ordered = [reports[n] for level in load_levels(dict(self.specs)) for n in level]
        if errors:
            raise LoadFailed(errors, ordered)
        return ordered

    def _check_domain(self, rows: DataFrame, resolved: DataFrame, spec: EntitySpec, listed: bool = True) -> int:
        """Every resolved row is checked, also one that a later row of its key would overwrite.
        A look at the one column of the source settles the usual case without any join."""
        name = f"{spec.name}_quarantine"
        stale = listed and self.on_violation == QUARANTINE and self.store.pointer(name) is not None
        if checks.domain_violations(rows, spec).isEmpty() and not stale:
            return 0
        bad = checks.domain_violations(resolved, spec)
        if self.on_violation == FAIL:
            found = bad.count()
            if found:
                raise checks.DomainViolation(f"{spec.name}: {found} rows outside {sorted(spec.domain)}")
            return 0
        if not listed:
            return bad.count()
        seen = Observation()
        version = self.store.write(name, bad.observe(seen, F.count(F.lit(1)).alias("n")))
        self.store.publish(name, version)
        return seen.get.get("n", 0)

    def _unresolved(self, spec: EntitySpec, entry: dict) -> DataFrame:
        schema = f"{spec.key} string, parent string, code string"
        if not entry.get("unresolved"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.store.folder(spec.name, entry["unresolved"]))

    def _still_waiting(self, spec: EntitySpec, before: dict, rows: DataFrame, ids: Mapping[str, DataFrame]) -> str:
        """Write what rows wait for after this load: these rows anew, those of other keys as before. The
        pointer of the new version makes it visible together with the rows."""
        fresh = unresolved(rows, spec, {p: self._rows(p) for p in ids}, ids, self.specs)
        others = with_keys(self._unresolved(spec, before), rows.select(spec.key), spec, "left anti")
        return self.store.write(spec.name, others.unionByName(fresh))

    def _layout(self, spec: EntitySpec, before: dict, rows: DataFrame, null_keys: bool) -> tuple[DataFrame, list[int] | None, dict]:
        """What the merge reads of the target, the buckets it rewrites (None: the whole table), and the new version's layout.

        If the published version has the wanted buckets and the rows' keys fall into some of them only, just
        these are merged and rewritten. Their numbers, no more than there are buckets, are collected.
        """
        target, n = self.current(spec.name), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if spec.name not in self.bucketed or spec.match != BINARY or null_keys:
            return target, None, {}
        has_buckets = bool(before.get("buckets"))  # such a version has no row without a key
        if not has_buckets and lacks_keys(target, spec):
            return target, None, {}
        if has_buckets and before["key"] == spec.key:
            found = rows.select(bucket_of(spec.key, before["buckets"]).alias("b")).distinct().collect()
            touched = sorted(r.b for r in found)
            if len(touched) < before["buckets"]:
                return self.store.read(spec.name, before, spec.target_schema, touched), touched, {"buckets": before["buckets"], "key": spec.key}
        return target, None, {"buckets": n, "key": spec.key}

    def _set_apart(self, spec: EntitySpec, target: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The part of a plain target that can hold the keys of some rows, and the rest (None: nothing), which stays as it is
        and is not shuffled. Told apart by the key's bucket, of as many as there are shuffle partitions; the numbers of
        those that the rows fall into are collected."""
        same_type = rows.schema[spec.key].dataType == target.schema[spec.key].dataType
        if spec.match != BINARY or not same_type:
            return target, None
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        bucket = bucket_of(spec.key, n)
        touched = sorted(r.b for r in rows.select(bucket.alias("b")).distinct().collect())
        if len(touched) == n:
            return target, None
        return target.filter(bucket.isin(touched)), target.filter(~bucket.isin(touched))

    def _buckets_for(self, rows: int) -> int:
        """How many buckets a table of so many rows is dealt out into; 0 for a table that a shuffle may move."""
        return max(2 * self.spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_BUCKET)) if rows > ROWS_PER_BUCKET else 0

    @staticmethod
    def _crowded(rows: DataFrame, column: str, buckets: int, without_null: bool = False) -> bool:
        """Whether a bucket by `column` would hold far more than its share, which a single task would have to work off.
        Reads the one column; a shuffle combines or splits such a key instead."""
        rows = rows.filter(F.col(column).isNotNull()) if without_null else rows
        largest = rows.groupBy(bucket_of(column, buckets).alias("b")).count().agg(F.max("count")).first()[0]
        return (largest or 0) > CROWDED * ROWS_PER_BUCKET

    def _top_id(self, spec: EntitySpec, before: dict) -> int | None:
        """The highest id of the whole published table, which a merge of some buckets does not see."""
        if not spec.surrogate:
            return None
        known = before.get("top_id")
        return (self.current(spec.name).agg(F.max(spec.surrogate)).first()[0] or 0) if known is None else known

    def _row_count(self, spec: EntitySpec, before: dict) -> int:
        known = before.get("n_rows")
        return self.current(spec.name).count() if known is None else known

    def _unique_by(self, spec: EntitySpec, before: dict) -> str | None:
        """The key comparison under which the merged table has no key twice. A merge adds only
        keys that are absent, so once a table is known to be free of repeats it stays so, unless keys hold within a scope only."""
        if not spec.surrogate:
            return None
        known = not spec.scope and (not before or before.get("unique_by") == spec.match)
        return spec.match if known or checks.ambiguous_keys(self.current(spec.name), spec).isEmpty() else None

    def _rows(self, name: str) -> DataFrame:
        """A source table. One that may change while it is read, such as a database table, is
        written out first, so that the whole run sees the same rows and reads them once."""
        if not getattr(self.source, "live", False):
            return self.source[name]
        return self._once.get(("rows", name), lambda: self.store.stage(f"source_{name}", self.source[name]))

    def _repeats_ids(self, name: str) -> bool:
        """Whether a source id occurs twice; looked up once per run, in the one column."""
        return self._once.get(("repeats", name), lambda: not repeated_ids(self._rows(name), self.specs[name]).isEmpty())

    def _parent(self, name: str) -> tuple[DataFrame, DataFrame | None]:
        """A parent's current table, checked for ambiguous keys unless known to have none, and, where
        it is too large to broadcast, its source-to-target ids, written once and shared by its
        children."""

        def prepare() -> tuple[DataFrame, DataFrame | None]:
            spec, rows, table = self.specs[name], self._rows(name), self.current(name)
            if (self.store.pointer(name) or {}).get("unique_by") != spec.match:
                checks.require_unambiguous(table, spec)
            if all(broadcastable(side.select(spec.surrogate, spec.key)) for side in (rows, table)):
                return table, None
            return table, self.store.stage(f"link_{name}", link(rows, table, spec, "left"))

        return self._once.get(("parent", name), prepare)


class _Dealt:
    """The bucketed intermediate tables of one load. Calling it deals out a table by a column. What was dealt out before is
    all in the loaded table when that is dealt out once more, and is removed then; `drop` removes the rest."""

    def __init__(self, store: TableStore, name: str):
        self.store, self.name, self.buckets, self._folders = store, name, 0, []

    def __call__(self, label: str, rows: DataFrame, column: str) -> DataFrame:
        tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-self.buckets // BUCKETS_PER_TASK))
        table, folder = self.store.stage_buckets(label, rows.coalesce(tasks), column, self.buckets)
        if label == self.name:
            self.drop()
        self._folders.append(folder)
        return table

    def drop(self) -> None:
        while self._folders:
            self.store.drop_staged(self._folders.pop())


class _OncePerKey:
    """Results computed once per key, also when several threads ask at the same time."""

    def __init__(self):
        self._lock = threading.Lock()
        self._locks: dict = {}
        self._results: dict = {}

    def get(self, key, compute):
        with self._lock:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if key not in self._results:
                self._results[key] = compute()
            return self._results[key]

    def forget(self, key) -> None:
        self._results.pop(key, None)


def report_frame(spark: SparkSession, reports: list[LoadReport]) -> DataFrame:
    """One row per entity."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in reports], REPORT_SCHEMA)
