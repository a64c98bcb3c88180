"""Rows that waited for an optional parent are loaded again once it is there, and only those."""

from __future__ import annotations

from collections import ChainMap
from datetime import datetime

import pytest

from conftest import RUN_TS, audit, canon, records, source_frame
from deskspark.operators.resolve import unresolved
from deskspark.plans.entities import ENTITIES
from deskspark.plans.loader import QUARANTINE, Loader
from deskspark.sources.store import TableStore

SPEC = ENTITIES["analista"]
LATER = datetime(2024, 3, 1)


def queues(spark, *numbers):
    return source_frame(spark, "fila", [{"id_fila": 100 + n, "cd_fila": f"F{n}", **audit()} for n in numbers])


def analysts(spark, pairs):
    """(number, queue) pairs; the place in the list is the order of changes."""
    rows = [{"id_analista": 500 + n, "cd_analista": f"A{n:02}", "id_fila_atual": queue and 100 + queue,
             **audit(changed=f"2023-12-{i % 28 + 1:02}")} for i, (n, queue) in enumerate(pairs)]
    return source_frame(spark, "analista", rows)


def queue_of(loader):
    """analyst -> code of the queue in the target."""
    codes = {r.id_fila: r.cd_fila for r in loader.current("fila").collect()}
    return {r.cd_analista: codes.get(r.id_fila_atual) for r in loader.current("analista").collect()}


def waiting(loader):
    return sorted(tuple(r) for r in loader.unresolved("analista").collect())


#: Analyst 5 was in queue 2 and left it; 6 has no queue; 7's queue is unknown at the source too.
PAIRS = [(n, n % 3 + 1) for n in range(5)] + [(5, 2), (5, None), (6, None), (7, 77)]


def loaded(spark, root, bucketed=("analista",), **options):
    """Analysts loaded while only queue 1 was there."""
    source = {"fila": queues(spark, 1), "analista": analysts(spark, PAIRS)}
    source["analista"] = source["analista"].coalesce(1)
    early = {"fila": queues(spark, 1)}
    store = TableStore(spark, str(root))
    all_queues = {"fila": queues(spark, 1, 2, 3), "analista": source["analista"]}
    Loader(spark, early, store, RUN_TS).load("fila")
    loader = Loader(spark, all_queues, store, RUN_TS, bucketed=bucketed, keep_unresolved=True, **options)
    loader.load("analista")
    return loader


@pytest.mark.parametrize("bucketed", [(), ("analista",)])
def test_repair_equals_loading_all_again(spark, tmp_path, bucketed):
    loader = loaded(spark, tmp_path / "a", bucketed)
    assert waiting(loader) == [("A01", "fila", "F2"), ("A02", "fila", "F3"), ("A04", "fila", "F2"), ("A05", "fila", "F2")]
    assert loader.repair("analista") is None  # nothing new yet
    version = loader.store.pointer("analista")["version"]
    loader.load("fila")
    later = Loader(spark, loader.source, loader.store, LATER, bucketed=bucketed, keep_unresolved=True)
    report = later.repair("analista")
    assert (report.rows_read, report.updated, report.inserted, report.kept) == (5, 4, 0, 4)
    assert queue_of(later) == {"A00": "F1", "A01": "F2", "A02": "F3", "A03": "F1", "A04": "F2", "A05": None, "A06": None, "A07": None}
    stamps = {r.cd_analista: r.dt_atualizacao for r in later.current("analista").collect()}
    assert {k for k, t in stamps.items() if t == LATER} == {"A01", "A02", "A04", "A05"}
    assert waiting(later) == [] and later.repair("analista") is None
    again = loaded(spark, tmp_path / "b", bucketed)
    again.load("fila")
    again.load("analista")
    columns = [c for c in SPEC.target_columns if c != "dt_atualizacao"]
    assert canon(records(later.current("analista")), columns) == canon(records(again.current("analista")), columns)
    assert later.store.pointer("analista")["version"] != version


def test_waiting_codes_survive_other_loads_and_vacuum(spark, tmp_path):
    loader = loaded(spark, tmp_path)
    some = Loader(spark, ChainMap({"analista": analysts(spark, [(1, 1), (8, 3)])}, loader.source), loader.store, LATER,
                  bucketed=["analista"], keep_unresolved=True)
    some.load("analista")  # analyst 1 moved to a known queue, 8 came to a missing one
    assert waiting(some) == [("A02", "fila", "F3"), ("A04", "fila", "F2"), ("A05", "fila", "F2"), ("A08", "fila", "F3")]
    plain = Loader(spark, {"fila": queues(spark, 1), "analista": analysts(spark, [(6, None)])}, loader.store, LATER, bucketed=["analista"])
    plain.load("analista")  # a load that does not keep them hands them on
    loader.store.vacuum("analista", grace_seconds=-1)
    assert [w[0] for w in waiting(loader)] == ["A02", "A04", "A05", "A08"]


def test_rows_without_key_or_code_do_not_wait(spark, tmp_path):
    rows = analysts(spark, [(1, 2), (1, 2), (2, None)]).unionByName(source_frame(spark, "analista", [{"id_fila_atual": 102}]))
    none = queues(spark)
    got = unresolved(rows, SPEC, {"fila": queues(spark, 2)}, {"fila": none})
    assert [tuple(r) for r in got.collect()] == [("A01", "fila", "F2")]
    assert unresolved(rows, SPEC, {"fila": none}, {"fila": none}).count() == 0
    assert unresolved(rows.limit(0), SPEC, {"fila": queues(spark, 2)}, {"fila": none}).count() == 0
    assert unresolved(queues(spark, 1), ENTITIES["fila"], {}, {}).count() == 0


def test_a_repair_leaves_the_lists_of_bad_rows(spark, tmp_path):
    name = "chamado_status_historico"
    store = TableStore(spark, str(tmp_path))
    ticket = source_frame(spark, "chamado", [{"id_chamado": 1, "nr_chamado": "T1"}])
    store.publish("chamado", store.write("chamado", ticket))
    steps = source_frame(spark, name, [
        {"cd_registro_origem": f"R{i}", "id_chamado": ticket_id, "id_fila": 101, "ds_status_chamado": status, **audit(record=f"R{i}")}
        for i, (ticket_id, status) in enumerate([(1, "OPEN"), (1, "REOPENED"), (9, "OPEN")])])
    source = {"chamado": ticket, "fila": queues(spark, 1), "analista": analysts(spark, []), name: steps}
    loader = Loader(spark, source, store, RUN_TS, QUARANTINE, keep_rejects=True, keep_unresolved=True)
    loader.load(name)
    lists = [store.pointer(f"{name}_{kind}")["version"] for kind in ("quarantine", "rejects")]
    loader.load("fila")
    assert loader.repair(name).updated == 1
    assert [store.pointer(f"{name}_{kind}")["version"] for kind in ("quarantine", "rejects")] == lists
    assert [r.id_fila for r in loader.current(name).collect()] == [1]
