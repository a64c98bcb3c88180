"""History as intervals against whole snapshots."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from conftest import OLD, RUN_TS, audit, canon, frame, records
from deskspark.plans.entities import ENTITIES
from deskspark.plans.loader import Loader
from deskspark.sources.history import History
from deskspark.sources.intervals import IntervalHistory
from deskspark.sources.store import TableStore

SPEC = ENTITIES["fila"]


def snapshot(spark, rows):
    return frame(spark, SPEC.target_schema, [{"id_fila": i, "cd_fila": c, "nm_fila": n, **OLD} for i, c, n in rows])


def test_intervals_give_back_every_snapshot(spark, tmp_path):
    r = random.Random(5)
    history, whole = IntervalHistory(spark, str(tmp_path / "i")), History(spark, str(tmp_path / "w"))
    first = date(2024, 1, 1)
    for k in range(5):
        rows = [(i, f"c{i}", r.choice([None, "x", "y"])) for i in range(12) if r.random() < 0.7]
        rows += [(None, None, "copy")] * r.choice([0, 2, 2, 3])  # rows without a key, several alike
        for h in (history, whole):
            h.append("fila", snapshot(spark, rows), first + timedelta(2 * k))
    for k in range(-1, 11):
        day = first + timedelta(k)
        want = whole.as_of("fila", SPEC.target_schema, day)
        got = history.as_of("fila", SPEC.target_schema, day)
        assert canon(records(got), SPEC.target_columns) == canon(records(want), SPEC.target_columns)
    n_rows = history.intervals("fila", SPEC.target_schema).count()
    assert n_rows < sum(whole.as_of("fila", SPEC.target_schema, first + timedelta(2 * k)).count() for k in range(5))


def test_a_date_may_be_run_again_but_not_an_earlier_one(spark, tmp_path):
    history = IntervalHistory(spark, str(tmp_path))
    for day, rows in ((1, [(1, "a", "x"), (2, "b", "x")]), (3, [(1, "a", "y")]), (3, [(1, "a", "x"), (3, "c", "x")])):
        history.append("fila", snapshot(spark, rows), date(2024, 1, day))
    found = {(r.cd_fila, r.nm_fila, r.valid_from.day, r.valid_to and r.valid_to.day) for r in history.intervals("fila", SPEC.target_schema).collect()}
    assert found == {("a", "x", 1, None), ("b", "x", 1, 3), ("c", "x", 3, None)}
    with pytest.raises(ValueError, match="before the last run date"):
        history.append("fila", snapshot(spark, []), date(2024, 1, 2))
    assert history.store.vacuum("fila", grace_seconds=0, now=2e10)  # folders of replaced states go, the history stays
    assert len(history.intervals("fila", SPEC.target_schema).collect()) == 3


def test_a_failure_before_the_publish_changes_nothing(spark, tmp_path, monkeypatch):
    history = IntervalHistory(spark, str(tmp_path / "h"))
    history.append("fila", snapshot(spark, [(1, "a", "x")]), date(2024, 1, 1))
    store = TableStore(spark, str(tmp_path / "s"))
    monkeypatch.setattr(history.store, "publish", lambda *a, **k: 1 / 0)
    source = {"fila": frame(spark, SPEC.source_schema, [{"id_fila": 1, "cd_fila": "b", **audit()}])}
    with pytest.raises(ZeroDivisionError):
        Loader(spark, source, store, RUN_TS, history=history).load("fila")
    assert store.pointer("fila") is None  # the table is published after its history
    again = IntervalHistory(spark, str(tmp_path / "h"))
    assert [r.cd_fila for r in again.as_of("fila", SPEC.target_schema, date(2024, 3, 1)).collect()] == ["a"]
    Loader(spark, source, store, RUN_TS, history=again).load("fila")
    assert [r.cd_fila for r in again.as_of("fila", SPEC.target_schema, date(2024, 3, 1)).collect()] == ["b"]


def test_an_as_of_reads_no_folder_closed_before(spark, tmp_path):
    history = IntervalHistory(spark, str(tmp_path))
    for k in range(4):
        history.append("fila", snapshot(spark, [(1, "a", f"n{k}")]), date(2024, 1, 1 + k))
    closed = history.store.pointer("fila")["closed"]
    assert sorted(closed) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    files = history.as_of("fila", SPEC.target_schema, date(2024, 1, 3)).inputFiles()
    assert any(closed["2024-01-04"] in f for f in files) and not any(closed[d] in f for d in ("2024-01-02", "2024-01-03") for f in files)
