"""What is sent to a database; the statements run here on an engine inside the test."""

from __future__ import annotations

import random

import duckdb
import pytest

from deskspark.plans.entities import ENTITIES
from deskspark.plans.spec import column_type
from deskspark.sources import jdbc


def plain(text: str) -> str:
    return text.replace("N'", "'")


@pytest.mark.parametrize("name", ENTITIES)
@pytest.mark.parametrize("n_rows, slices", [(0, 4), (1, 4), (3, 64), (500, 7)])
def test_ranges_are_disjoint_and_complete(name, n_rows, slices):
    spec, r = ENTITIES[name], random.Random(n_rows)
    column = jdbc.slice_column(spec)
    ids = column_type(column).simpleString() == "bigint"
    con = duckdb.connect()
    con.execute(f"CREATE SCHEMA itsm; CREATE TABLE itsm.{name} ({column} {'BIGINT' if ids else 'VARCHAR'}, place INT)")
    draw = (lambda: r.randint(-50, 9000)) if ids else (lambda: r.choice(["", "O'Neil", "Ä", "zz", " "]) + str(r.randint(0, 99)))
    rows = [(None if r.random() < 0.2 else draw(), k) for k in range(n_rows)]
    if rows:
        con.executemany(f"INSERT INTO itsm.{name} VALUES (?, ?)", rows)
    found = con.execute(jdbc.bounds_query(spec, "itsm", slices)).fetchall()
    bounds = jdbc.bounds_of(found, column, slices)
    predicates = jdbc.range_predicates(column, bounds)
    assert len(predicates) <= slices + 1 and predicates[-1] == f"{column} IS NULL"
    con.execute(f"INSERT INTO itsm.{name} VALUES (?, -1), (?, -2)", [10**9 if ids else "zzzz", -10**9 if ids else ""])  # added meanwhile
    read = [x for p in predicates for (x,) in con.execute(f"SELECT place FROM itsm.{name} WHERE {plain(p)}").fetchall()]
    assert sorted(read) == sorted([k for _, k in rows] + [-1, -2])


def test_slices_are_of_like_size():
    assert jdbc.even_bounds(1, 100, 4) == [26, 51, 76] and jdbc.even_bounds(5, 5, 9) == [] and jdbc.even_bounds(None, None, 3) == []
    assert jdbc.range_predicates("k", []) == ["k IS NOT NULL", "k IS NULL"]
    for spec in ENTITIES.values():  # nothing that a running system changes decides where a row is read
        assert jdbc.slice_column(spec) in (spec.surrogate, spec.key)


SQL_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}


def portable(statements):
    """Without the one statement that only the real database knows."""
    return [s for s in statements if "OBJECTPROPERTY" not in s]


@pytest.mark.parametrize("name", ENTITIES)
def test_an_export_takes_over_all_rows_or_none(name):
    spec = ENTITIES[name]
    export = jdbc.export_of(spec, "corptech", "t1")
    identity = [s for s in export.transaction if "IDENTITY_INSERT" in s]
    assert len(identity) == (2 if spec.surrogate else 0) and export.transaction[-1:] == tuple(identity[-1:] or [export.transaction[-1]])
    assert export.before[1].startswith("SELECT") and f"INTO {export.side} FROM" in export.before[1] and "UNION ALL" in export.before[1]
    con = duckdb.connect()
    columns = ", ".join(f"{f.name} {SQL_TYPES[f.dataType.simpleString()]}" for f in spec.target_schema)
    con.execute(f"CREATE SCHEMA corptech; CREATE TABLE corptech.{name} ({columns}); CREATE TABLE {export.side} ({columns})")
    by = jdbc.slice_column(spec)
    number = column_type(by).simpleString() == "bigint"
    other = next(c for c in spec.insert_columns if c != by and column_type(c).simpleString() == "string")
    value = lambda k: k if number or k is None else f"k{k}"
    add = lambda table, rows: con.executemany(f"INSERT INTO {table} ({by}, {other}) VALUES (?, ?)", [(value(k), v) for k, v in rows])
    unkeyed = [] if spec.surrogate else [(None, "old"), (None, "old")]
    loaded = [(1, "new"), (2, None), (3, "added"), *([] if spec.surrogate else [(None, "old"), (None, "old"), (None, "fresh")])]
    add(f"corptech.{name}", [(1, "old"), (2, "old"), *unkeyed])
    add(export.side, loaded)
    rows = lambda: sorted(map(repr, con.execute(f"SELECT {by}, {other} FROM corptech.{name}").fetchall()))
    before = rows()
    con.begin()
    for s in portable(export.transaction):
        con.execute(s)
    con.rollback()
    assert rows() == before
    for _ in range(2):  # a second export of the same load changes nothing
        con.begin()
        for s in portable(export.transaction):
            con.execute(s)
        con.commit()
        assert rows() == sorted(repr((value(k), v)) for k, v in loaded)
    con.execute(export.after[0])


def test_a_failed_write_leaves_the_table_and_drops_the_side(spark):
    ran = []
    spec = ENTITIES["sla"]
    rows = spark.createDataFrame([], spec.target_schema)
    options = {"url": "jdbc:none:x", "driver": "no.such.Driver", "user": "u", "password": "p"}
    with pytest.raises(Exception):
        jdbc.write_table(rows, spec, options, "corptech", run=lambda s, o, statements, whole: ran.append((tuple(statements), whole)))
    assert [whole for _, whole in ran] == [False, False] and ran[-1][0][0].startswith("DROP TABLE IF EXISTS corptech.sla__")


def test_an_export_by_key_within_a_scope():
    spec = ENTITIES["csat_avaliacao"].with_options(scope=("nm_sistema_origem",))
    export = jdbc.export_of(spec, "corptech", "t")
    con = duckdb.connect()
    columns = ", ".join(f"{f.name} {SQL_TYPES[f.dataType.simpleString()]}" for f in spec.target_schema)
    con.execute(f"CREATE SCHEMA corptech; CREATE TABLE corptech.{spec.name} ({columns}); CREATE TABLE {export.side} ({columns})")
    add = lambda table, rows: con.executemany(
        f"INSERT INTO {table} (cd_registro_origem, nm_sistema_origem, ds_comentario) VALUES (?, ?, ?)", rows)
    add(f"corptech.{spec.name}", [("k", "A", "old"), ("k", "B", "old"), ("k", None, "old")])
    add(export.side, [("k", "A", "old"), ("k", "B", "new"), ("k", None, "new"), ("k", "C", "added")])
    for s in portable(export.transaction):
        con.execute(s)
    rows = con.execute(f"SELECT nm_sistema_origem, ds_comentario FROM corptech.{spec.name}").fetchall()
    assert sorted(rows, key=str) == sorted([("A", "old"), ("B", "new"), (None, "new"), ("C", "added")], key=str)
