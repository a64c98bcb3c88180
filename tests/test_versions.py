"""Versions that rewrite some buckets, writers that race, and what may be removed."""

from __future__ import annotations

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from conftest import OLD, RUN_TS, audit, canon, frame, records
from deskspark.operators.upsert import merge
from deskspark.plans.entities import ENTITIES
from deskspark.plans.loader import Loader
from deskspark.sources.store import PublishConflict, TableStore, bucket_of
from deskspark.streaming.arrivals import load_arrivals

SPEC = ENTITIES["fila"]


def queues(spark, codes, schema=SPEC.target_schema, **more):
    return frame(spark, schema, [{"id_fila": i + 1, "cd_fila": c, **(more or OLD)} for i, c in enumerate(codes)])


def codes_of(store):
    return sorted(r.cd_fila for r in store.current("fila", SPEC.target_schema).collect())


def bucketed_store(spark, root, n=60):
    """A table of queues in 4 buckets, published by a load."""
    store = TableStore(spark, str(root))
    source = {"fila": queues(spark, [f"Q{i:03}" for i in range(n)], SPEC.source_schema, **audit())}
    Loader(spark, source, store, RUN_TS, bucketed=["fila"]).load("fila")
    return store


def in_bucket(spark, bucket, prefix="Q"):
    codes = spark.range(500).selectExpr(f"concat('{prefix}', lpad(id, 3, '0')) AS c")
    return [r.c for r in codes.filter(bucket_of("c", 4) == bucket).orderBy("c").collect()]


def test_a_load_reads_and_writes_only_the_buckets_of_its_keys(spark, tmp_path):
    store = bucketed_store(spark, tmp_path)
    before = store.pointer("fila")
    old_files = store.files("fila", before)
    known, fresh = in_bucket(spark, 2)[:2], in_bucket(spark, 2, "N")[:3]
    changed = queues(spark, known + fresh, SPEC.source_schema, **audit(system="NEW"))
    report = Loader(spark, {"fila": changed}, store, RUN_TS, bucketed=["fila"]).load("fila")
    after = store.pointer("fila")
    assert (report.inserted, report.updated, report.kept) == (3, 2, 58) and after["n_rows"] == 63
    stay = [f for f in old_files if "_00002." not in f]
    assert set(stay) < set(store.files("fila", after)) and stay == sorted(f for f in store.files("fila", after) if f in old_files)
    rows = {r.cd_fila: r for r in store.current("fila", SPEC.target_schema).collect()}
    assert len(rows) == 63 and {c for c, r in rows.items() if r.nm_sistema_origem == "NEW"} == {*known, *fresh}
    assert sorted(r.id_fila for r in rows.values()) == list(range(1, 64)) and {rows[c].id_fila for c in fresh} == {61, 62, 63}
    assert after["top_id"] == 63


def test_partly_rewritten_tables_equal_plain_ones_and_stay_bucketed(spark, tmp_path):
    store, plain = bucketed_store(spark, tmp_path / "a"), TableStore(spark, str(tmp_path / "b"))
    source = {"fila": queues(spark, [f"Q{i:03}" for i in range(60)], SPEC.source_schema, **audit())}
    Loader(spark, source, plain, RUN_TS).load("fila")
    for k, codes in enumerate([in_bucket(spark, 1)[:3], in_bucket(spark, 3, "N")[:2] + in_bucket(spark, 1)[1:2], ["Q007"], []]):
        rows = {"fila": queues(spark, codes, SPEC.source_schema, **audit(system=f"S{k}"))}
        reports = [Loader(spark, rows, s, RUN_TS, bucketed=b).load("fila") for s, b in ((store, ["fila"]), (plain, []))]
        assert reports[0] == reports[1]
        assert canon(records(store.current("fila", SPEC.target_schema)), SPEC.target_columns) == canon(
            records(plain.current("fila", SPEC.target_schema)), SPEC.target_columns)
    assert len(store.pointer("fila")["held_in"]) > 1
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = queues(spark, ["Q001"]).select(*SPEC.insert_columns)
        spec = SPEC.with_options(surrogate=None)
        merged = merge(store.current("fila", SPEC.target_schema), rows, spec, RUN_TS, null_keys=False, target_null_keys=False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1


def test_a_stream_leaves_other_buckets_files_alone(spark, tmp_path):
    store = bucketed_store(spark, tmp_path / "store")
    files = [store.files("fila", store.pointer("fila"))]
    for k, bucket in enumerate((0, 3, 3)):
        codes = in_bucket(spark, bucket)[k:k + 2]
        queues(spark, codes, SPEC.source_schema, **audit(system=f"B{k}")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        arrivals = spark.readStream.schema(SPEC.source_schema).parquet(str(tmp_path / "in"))
        load_arrivals(arrivals, "fila", lambda session: {}, store, str(tmp_path / "checkpoint"), RUN_TS).awaitTermination()
        files.append(store.files("fila", store.pointer("fila")))
        gone = set(files[-2]) - set(files[-1])
        assert gone and all(f"_{bucket:05}." in f for f in gone)
    assert len(codes_of(store)) == 60


def test_one_of_two_racing_writers_publishes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.publish("fila", store.write("fila", queues(spark, ["a"]), "first"))
    versions = [store.write("fila", queues(spark, [f"w{i}"]), f"w{i}") for i in range(8)]
    start = threading.Barrier(len(versions))

    def attempt(version):
        start.wait()
        try:
            store.publish("fila", version, expected="first")
            return version
        except PublishConflict:
            return None

    with ThreadPoolExecutor(len(versions)) as pool:
        won = [v for v in pool.map(attempt, versions) if v]
    assert len(won) == 1 and codes_of(store) == won
    assert [s.getPath().getName() for s in store._list("fila/_pointers") if s.getPath().getName().endswith(".draft")] == []
    with ThreadPoolExecutor(4) as pool:  # without an expected version all publish, one after the other
        list(pool.map(lambda v: store.publish("fila", v), versions[:4]))
    assert store._last_number("fila") == 6


def test_an_old_pointer_file_is_still_read(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    version = store.write("fila", queues(spark, ["a"]))
    (tmp_path / "fila" / "CURRENT").write_text(f'{{"version": "{version}"}}')
    assert codes_of(store) == ["a"]
    store.publish("fila", store.write("fila", queues(spark, ["b"])), expected=version)
    assert codes_of(store) == ["b"]


def test_a_reader_of_a_lost_race_and_a_failing_publish_change_nothing(spark, tmp_path):
    store = bucketed_store(spark, tmp_path)
    loader = Loader(spark, {"fila": queues(spark, ["Q001"], SPEC.source_schema, **audit())}, store, RUN_TS, bucketed=["fila"])
    write = store.write_buckets

    def overtaken(name, *rest):
        done = write(name, *rest)
        store.publish(name, store.write(name, queues(spark, ["other"])))
        return done

    store.write_buckets = overtaken
    with pytest.raises(PublishConflict):
        loader.load("fila")
    assert codes_of(store) == ["other"]


def test_vacuum_spares_what_pointers_and_late_readers_reach(spark, tmp_path):
    store = bucketed_store(spark, tmp_path)
    first = store.pointer("fila")["version"]
    for bucket in (1, 2):
        rows = {"fila": queues(spark, in_bucket(spark, bucket)[:1], SPEC.source_schema, **audit())}
        Loader(spark, rows, store, RUN_TS, bucketed=["fila"]).load("fila")
    store.write("fila", queues(spark, ["unpublished"]), "late")
    reader = store.current("fila", SPEC.target_schema)
    assert store.vacuum("fila", keep=3, grace_seconds=3600) == []
    assert store.vacuum("fila", now=time.time() + 10, grace_seconds=0) == ["v=late"]  # the first folder still holds buckets 0 and 3
    assert reader.count() == 60 and store.pointer("fila", 1) is None
    whole = {"fila": queues(spark, [f"Q{i:03}" for i in range(60)], SPEC.source_schema, **audit())}
    Loader(spark, whole, store, RUN_TS, bucketed=["fila"]).load("fila")
    assert store.vacuum("fila", grace_seconds=3600) == [] and reader.count() == 60
    gone = store.vacuum("fila", now=time.time() + 10, grace_seconds=0)
    assert f"v={first}" in gone and len(gone) == 3 and len(codes_of(store)) == 60
    store.stage("x", queues(spark, ["a"]))
    assert store.vacuum_staging(grace_seconds=3600) == [] and len(store.vacuum_staging(0, time.time() + 10)) == 1


def test_codes_of_two_systems_in_buckets(spark, tmp_path):
    """Key and system together are the merge key; buckets go by the key, so a code's rows stay together."""
    spec = SPEC.with_options(scope=("nm_sistema_origem",))
    store, specs = TableStore(spark, str(tmp_path)), {"fila": spec}
    load = lambda rows: Loader(spark, {"fila": rows}, store, RUN_TS, specs=specs, bucketed=["fila"]).load("fila")
    codes = [f"Q{i:03}" for i in range(60)]
    rows = [queues(spark, codes, SPEC.source_schema, **audit(system=s)) for s in ("A", "B")]
    assert load(rows[0].union(rows[1])).inserted == 120
    some = in_bucket(spark, 2)[:2]
    report = load(queues(spark, some, SPEC.source_schema, **audit(system="B")).union(
        queues(spark, some[:1], SPEC.source_schema, **audit(system="C"))))
    assert (report.inserted, report.updated, report.kept) == (1, 2, 118)
    got = store.current("fila", SPEC.target_schema).collect()
    assert sorted(r.id_fila for r in got) == list(range(1, 122))
    assert sorted((r.cd_fila, r.nm_sistema_origem) for r in got) == sorted(
        [(c, s) for c in codes for s in "AB"] + [(some[0], "C")])
    assert store.pointer("fila")["unique_by"] is None
    full = load(rows[0])
    assert (full.inserted, full.updated, full.kept) == (0, 60, 61)
    files = store.files("fila", store.pointer("fila"))
    assert len(files) == 4  # a file a bucket
