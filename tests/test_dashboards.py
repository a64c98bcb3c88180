"""Tallies kept up to date equal the numbers counted on the whole tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from conftest import canon, frame, records
from deskspark.operators import metrics
from deskspark.plans.dashboards import DASHBOARDS, Dashboards
from deskspark.plans.entities import ENTITIES
from deskspark.sources.store import PublishConflict, TableStore, bucket_of

BUCKETS = 4
STATUSES = ("OPEN", "IN_PROGRESS", "PENDING", "RESOLVED", "CLOSED", None)


def fact_rows(fact, keys, seed):
    """A row for each key, with NULLs, months, scores and parents drawn by `seed`."""
    rng = random.Random(seed)
    spec, rows = ENTITIES[fact], []
    for key in keys:
        start = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(200_000))
        made = {
            "ds_status_chamado": rng.choice(STATUSES), "ds_prioridade": rng.choice(("HIGH", "LOW", None)),
            "id_fila_atual": rng.choice((1, 2, 9, None)), "dt_criacao": rng.choice((start, None)),
            "dt_resolucao": rng.choice((start + timedelta(seconds=rng.randrange(9_999)), None)),
            "id_sla": rng.choice((1, 2, 9)), "fl_breach": rng.choice((True, False, None)),
            "nr_score": rng.choice((1, 4, 5, None)), "id_analista": rng.choice((1, 2, None)),
            "qt_tempo_status_minutos": rng.choice((0, 7, 30, None)),
        }
        rows.append({**{c: v for c, v in made.items() if c in spec.target_columns}, spec.key: key})
    return rows


def names(spark, store):
    for name, rows in {
        "fila": [{"id_fila": i, "cd_fila": f"F{i}"} for i in (1, 2)],
        "sla": [{"id_sla": i, "cd_sla": f"S{i}", "nm_sla": "s"} for i in (1, 2)],
        "analista": [{"id_analista": i, "cd_analista": f"A{i}"} for i in (1, 2)],
    }.items():
        store.publish(name, store.write(name, frame(spark, ENTITIES[name].target_schema, rows)))


def publish_whole(spark, store, fact, rows):
    spec = ENTITIES[fact]
    df = frame(spark, spec.target_schema, rows).repartition(BUCKETS, spec.key)
    store.publish(fact, store.write(fact, df, buckets=BUCKETS, key=spec.key), buckets=BUCKETS, key=spec.key)


def publish_bucket(spark, store, fact, bucket, rows):
    """Put `rows`, all of one bucket, in the place of what the bucket held."""
    before = store.pointer(fact)
    version, layout = store.write_buckets(fact, frame(spark, ENTITIES[fact].target_schema, rows), before, [bucket])
    store.publish(fact, version, expected=before["version"], **layout)


def by_bucket(spark, n=80):
    keys = spark.range(n).selectExpr("concat('K', id) AS k").withColumn("b", bucket_of("k", BUCKETS))
    found = {}
    for r in keys.collect():
        found.setdefault(r.b, []).append(r.k)
    return found


def whole(store, name):
    board = DASHBOARDS[name]
    tables = [store.current(t, ENTITIES[t].target_schema) for t in (board.fact, *board.names)]
    return getattr(metrics, name)(*tables)


def same(boards, store, name):
    got, want = boards.report(name), whole(store, name)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    return canon(records(got), want.columns) == canon(records(want), want.columns)


@pytest.mark.parametrize("name", sorted(DASHBOARDS))
def test_refreshed_numbers_are_those_of_the_whole_table(spark, tmp_path, name):
    store, fact = TableStore(spark, str(tmp_path)), DASHBOARDS[name].fact
    names(spark, store)
    boards, keys = Dashboards(spark, store), by_bucket(spark)
    assert boards.refresh(name) is None and same(boards, store, name)  # no facts yet
    publish_whole(spark, store, fact, fact_rows(fact, [k for b in keys.values() for k in b], 0))
    assert boards.refresh(name) is None and same(boards, store, name)
    assert boards.refresh(name) == []
    publish_bucket(spark, store, fact, 1, fact_rows(fact, keys[1] + keys[1][:3], 1))  # keys twice are counted twice
    assert boards.refresh(name) == [1] and same(boards, store, name)
    publish_bucket(spark, store, fact, 3, fact_rows(fact, keys[3], 2))
    publish_bucket(spark, store, fact, 1, [])
    publish_bucket(spark, store, fact, 3, fact_rows(fact, keys[3][:1], 3))
    assert boards.refresh(name) == [1, 3] and same(boards, store, name)


def test_a_refresh_reads_only_changed_buckets(spark, tmp_path, monkeypatch):
    store, keys = TableStore(spark, str(tmp_path)), by_bucket(spark)
    names(spark, store)
    publish_whole(spark, store, "chamado", fact_rows("chamado", [k for b in keys.values() for k in b], 0))
    boards = Dashboards(spark, store)
    boards.refresh_all()
    publish_bucket(spark, store, "chamado", 2, fact_rows("chamado", keys[2], 1))
    seen, read = [], store.read

    def watched(name, entry, schema, buckets=None):
        df = read(name, entry, schema, buckets)
        if name == "chamado":
            seen.extend(df.inputFiles())
        return df

    monkeypatch.setattr(store, "read", watched)
    assert boards.refresh("open_tickets") == [2]
    assert seen and all("_00002." in f for f in seen)
    seen.clear()
    records(boards.report("open_tickets"))
    assert not seen


def test_a_removed_version_is_not_taken_for_an_empty_one(spark, tmp_path):
    store, keys = TableStore(spark, str(tmp_path)), by_bucket(spark)
    names(spark, store)
    publish_whole(spark, store, "chamado", fact_rows("chamado", [k for b in keys.values() for k in b], 0))
    boards = Dashboards(spark, store)
    publish_bucket(spark, store, "chamado", 0, fact_rows("chamado", keys[0], 1))
    boards.refresh("ticket_overview")
    publish_bucket(spark, store, "chamado", 0, fact_rows("chamado", keys[0][:2], 2))
    assert store.vacuum("chamado", grace_seconds=-1)
    assert boards.refresh("ticket_overview") is None and same(boards, store, "ticket_overview")


def test_of_two_refreshes_one_counts(spark, tmp_path, monkeypatch):
    store, keys = TableStore(spark, str(tmp_path)), by_bucket(spark)
    names(spark, store)
    publish_whole(spark, store, "chamado", fact_rows("chamado", [k for b in keys.values() for k in b], 0))
    boards = Dashboards(spark, store)
    boards.refresh("closed_tickets")
    publish_bucket(spark, store, "chamado", 0, fact_rows("chamado", keys[0], 1))
    late, write = Dashboards(spark, store), store.write

    def overtaken(name, df, *more, **layout):
        version = write(name, df, *more, **layout)
        monkeypatch.setattr(store, "write", write)
        boards.refresh("closed_tickets")
        return version

    monkeypatch.setattr(store, "write", overtaken)
    with pytest.raises(PublishConflict):
        late.refresh("closed_tickets")
    assert same(boards, store, "closed_tickets") and boards.refresh("closed_tickets") == []
