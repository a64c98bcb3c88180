from __future__ import annotations

from datetime import date

import pytest

from conftest import OLD, audit, canon, frame, records
from deskspark.plans.entities import ENTITIES
from deskspark.sources.files import FileSource, write_file
from deskspark.sources.history import History
from deskspark.sources.store import TableStore

SPEC = ENTITIES["fila"]


def queues(spark, *codes):
    return frame(spark, SPEC.target_schema, [{"id_fila": i, "cd_fila": c, **OLD} for i, c in enumerate(codes)])


def test_readers_see_a_version_or_the_next(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.current("fila", SPEC.target_schema).count() == 0
    store.publish("fila", store.write("fila", queues(spark, "a")))
    before = store.current("fila", SPEC.target_schema)
    version = store.write("fila", queues(spark, "a", "b"))
    assert store.current("fila", SPEC.target_schema).count() == 1
    store.publish("fila", version, rows=2)
    assert store.current("fila", SPEC.target_schema).count() == 2
    assert before.count() == 1
    assert store.pointer("fila") == {"version": version, "rows": 2}


def test_a_failed_write_publishes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.publish("fila", store.write("fila", queues(spark, "a")))
    broken = queues(spark, "b").selectExpr("id_fila", "CAST(cd_fila AS INT) AS cd_fila")
    with pytest.raises(Exception):
        store.write("fila", broken, "next")
    assert [r.cd_fila for r in store.current("fila", SPEC.target_schema).collect()] == ["a"]
    store.publish("fila", store.write("fila", queues(spark, "c"), "next"))
    assert [r.cd_fila for r in store.current("fila", SPEC.target_schema).collect()] == ["c"]
    with pytest.raises(ValueError):
        store.write("fila", queues(spark, "d"), "next")


ODD = ['with "quotes"', "two\nlines", "", None, " blank ", "comma, semicolon;", "\\N?"]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_files_round_trip(spark, tmp_path, fmt):
    rows = [{"id_fila": i, "cd_fila": f"c{i}", "ds_descricao": d, "fl_ativo": None, **audit()} for i, d in enumerate(ODD)]
    table = frame(spark, SPEC.source_schema, rows)
    write_file(table, f"{tmp_path}/fila", fmt)
    got = FileSource(spark, str(tmp_path), fmt)["fila"]
    assert got.schema == SPEC.source_schema
    assert canon(records(got), SPEC.target_columns) == canon(records(table), SPEC.target_columns)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_history_as_of(spark, tmp_path, fmt):
    history = History(spark, str(tmp_path), fmt)
    assert history.as_of("fila", SPEC.target_schema, date(2024, 1, 1)).count() == 0
    for day, codes in ((date(2024, 1, 1), "a"), (date(2024, 1, 3), "ab"), (date(2024, 1, 3), "abc")):
        history.append("fila", queues(spark, *codes), day)
    seen = lambda day: history.as_of("fila", SPEC.target_schema, day)
    assert history.run_dates("fila") == [date(2024, 1, 1), date(2024, 1, 3)]
    assert seen(date(2023, 12, 31)).count() == 0
    assert [(r.cd_fila, r.run_date) for r in seen(date(2024, 1, 2)).collect()] == [("a", date(2024, 1, 1))]
    assert sorted(r.cd_fila for r in seen(date(2024, 2, 1)).collect()) == ["a", "b", "c"]
