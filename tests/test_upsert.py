"""Set-based upsert against a row-at-a-time model."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from conftest import OLD, RUN_TS, audit, canon, frame, records
from deskspark.operators.upsert import ACTION, BOOKKEEPING, COUNT, fold, lacks_keys, merge
from deskspark.plans.entities import ENTITIES
from deskspark.plans.spec import schema_of


def normal(key, spec):
    return key if spec.match == "binary" else key.rstrip().lower()


def row_by_row(target, rows, spec, run_ts):
    """Apply the rows one at a time, in the spec's order, NULL first."""
    state = [dict(t) for t in target]

    def place(row):
        return [(row[c] is not None, row[c]) for c in spec.order_columns if row[c] is not None or True]

    for row in sorted(rows, key=lambda r: [(v is not None, v if v is not None else 0) for _, v in place(r)]):
        hits = [t for t in state if row[spec.key] is not None and t[spec.key] is not None
                and normal(t[spec.key], spec) == normal(row[spec.key], spec) and all(t[c] == row[c] for c in spec.scope)]
        for t in hits:
            t.update({c: row[c] for c in spec.update_columns})
            if spec.stamped:
                t["dt_atualizacao"] = run_ts
        if not hits:
            state.append({**{c: row[c] for c in spec.insert_columns}, "new": True})
    return state


def random_rows(spec, keys, count, seed, null_keys=True):
    pick = random.Random(seed)

    def value(field):
        kind = field.dataType.simpleString()
        if pick.random() < 0.15:
            return None
        if kind == "bigint":
            return pick.randrange(1000)
        if kind == "int":
            return pick.randrange(5)
        if kind == "boolean":
            return pick.random() < 0.5
        if kind == "timestamp_ntz":
            return datetime(2023, 1, 1) + timedelta(hours=pick.randrange(500))
        return f"v{pick.randrange(50)}"

    rows = []
    for _ in range(count):
        row = {f.name: value(f) for f in schema_of(spec.insert_columns)}
        row[spec.key] = pick.choice(keys) if not null_keys or pick.random() > 0.1 else None
        rows.append(row)
    return rows


def random_target(spec, keys, seed):
    rows = random_rows(spec, keys, len(keys), seed, null_keys=False)
    for i, (row, key) in enumerate(zip(rows, keys)):
        row[spec.key] = key
        if spec.surrogate:
            row[spec.surrogate] = 100 + i
    extra = random_rows(spec, keys, 2, seed + 1)
    for i, row in enumerate(extra):
        row[spec.key] = None
        if spec.surrogate:
            row[spec.surrogate] = 500 + i
    return rows + extra


@pytest.mark.parametrize("name", ["sla", "solicitante", "chamado_status_historico", "csat_avaliacao"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_row_by_row(spark, name, seed):
    spec = ENTITIES[name]
    keys = [f"K{i}" for i in range(40)]
    target = random_target(spec, keys[:25], seed)
    rows = random_rows(spec, keys[10:], 90, seed + 10)
    want = row_by_row(target, rows, spec, RUN_TS)
    got = merge(frame(spark, spec.target_schema, target), frame(spark, schema_of(spec.insert_columns), rows),
                spec, RUN_TS)
    got = records(got)
    assert canon(got, spec.insert_columns) == canon(want, spec.insert_columns)
    assert sum(r[COUNT] for r in got) == len(rows)
    if spec.surrogate:
        ids = [r[spec.surrogate] for r in got]
        assert len(set(ids)) == len(ids) and None not in ids
        fresh = sorted(r[spec.surrogate] for r in got if r[ACTION] == "insert")
        assert fresh == list(range(502, 502 + len(fresh)))
        kept = {r[spec.key]: r[spec.surrogate] for r in got if r[ACTION] != "insert" and r[spec.key]}
        assert all(kept[t[spec.key]] == t[spec.surrogate] for t in target if t[spec.key])


def test_placeholder_table_has_no_stamp(spark):
    spec = ENTITIES["csat"]
    target = frame(spark, spec.target_schema, [{"Id": 1, "Column1": "a", "Column2": "a"}, {"Id": 2, "Column1": "b"}])
    rows = frame(spark, spec.target_schema, [{"Id": 1, "Column1": "x"}, {"Id": 3, "Column1": "y", "Column2": "z"}])
    got = merge(target, rows, spec, RUN_TS).drop(*BOOKKEEPING)
    assert sorted(map(tuple, got.collect())) == [(1, "x", None), (2, "b", None), (3, "y", "z")]


def test_case_insensitive_keys(spark):
    spec = ENTITIES["sla"].with_options(match="case_insensitive")
    target = [{"id_sla": 7, "cd_sla": "Gold", "nm_sla": "old", **OLD}]
    rows = [
        {"cd_sla": "GOLD  ", "nm_sla": "new", **audit()},
        {"cd_sla": "silver", "nm_sla": "first", **audit(changed="2023-01-01")},
        {"cd_sla": "SILVER", "nm_sla": "second", **audit(changed="2023-01-02")},
    ]
    rows = [{**dict.fromkeys(spec.insert_columns), **r} for r in rows]
    want = row_by_row([{**dict.fromkeys(spec.target_columns), **t} for t in target], rows, spec, RUN_TS)
    got = records(merge(frame(spark, spec.target_schema, target),
                        frame(spark, schema_of(spec.insert_columns), rows), spec, RUN_TS))
    assert canon(got, spec.insert_columns) == canon(want, spec.insert_columns)
    assert {r["cd_sla"]: r["id_sla"] for r in got} == {"Gold": 7, "silver": 8}


def test_rerun_changes_the_stamp_only(spark):
    spec = ENTITIES["fila"]
    keys = [f"K{i}" for i in range(20)]
    target = frame(spark, spec.target_schema, random_target(spec, keys[:12], 5))
    rows = frame(spark, schema_of(spec.insert_columns), random_rows(spec, keys, 30, 6, null_keys=False))
    once = merge(target, rows, spec, RUN_TS).drop(*BOOKKEEPING)
    twice = merge(once, rows, spec, RUN_TS).drop(*BOOKKEEPING)
    still = [c for c in spec.target_columns if c != "dt_atualizacao"]
    assert canon(records(once), still) == canon(records(twice), still)


def test_empty_source_keeps_the_target(spark):
    spec = ENTITIES["sla"]
    target = frame(spark, spec.target_schema, random_target(spec, ["a", "b"], 3))
    rows = frame(spark, schema_of(spec.insert_columns), [])
    got = merge(target, rows, spec, RUN_TS)
    assert canon(records(got), spec.target_columns) == canon(records(target), spec.target_columns)


def test_repeated_target_keys_are_all_updated(spark):
    spec = ENTITIES["csat_avaliacao"]
    target = [{"cd_registro_origem": "A", "nr_score": 1, "dt_inclusao": datetime(2022, 1, i)} for i in (1, 2)]
    rows = [{"cd_registro_origem": "A", "nr_score": 5, "id_chamado": 1}]
    got = records(merge(frame(spark, spec.target_schema, target),
                        frame(spark, schema_of(spec.insert_columns), rows), spec, RUN_TS))
    assert [(r["nr_score"], r["dt_atualizacao"]) for r in got] == [(5, RUN_TS)] * 2


def test_hot_key_is_combined_before_the_shuffle(spark):
    spec = ENTITIES["csat_avaliacao"]
    rows = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'K' || id END AS cd_registro_origem", "CAST(id AS INT) AS nr_score",
        "'c' AS ds_comentario", "TIMESTAMP_NTZ '2023-01-01 00:00:00' AS dt_avaliacao", "id AS id_chamado",
        "id AS id_analista", "TIMESTAMP_NTZ '2023-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT)) AS dt_inclusao",
        "TIMESTAMP_NTZ '2023-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT)) AS dt_atualizacao",
        "'S' AS nm_sistema_origem",
    )
    folded = fold(rows, spec)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan
    hot = folded.filter("_k = 'hot'").first()
    assert (hot.nr_score, hot[COUNT], hot.dt_inclusao) == (8997, 3000, datetime(2023, 1, 1))
    assert folded.count() == 6001


def test_lacks_keys(spark):
    spec = ENTITIES["csat"]
    assert lacks_keys(frame(spark, spec.target_schema, [{"Id": 1}, {}]), spec)
    assert not lacks_keys(frame(spark, spec.target_schema, [{"Id": 1}]), spec)


@pytest.mark.parametrize("match", ["binary", "case_insensitive"])
@pytest.mark.parametrize("name", ["solicitante", "csat_avaliacao"])
def test_keys_of_several_systems(spark, name, match):
    """The same codes in three systems, one of them NULL, are different rows."""
    spec = ENTITIES[name].with_options(scope=("nm_sistema_origem",), match=match)
    pick = random.Random(7)
    rows = random_rows(spec, ["a", "b", "c"], 80, 3)
    for r in rows:
        r["nm_sistema_origem"] = pick.choice(["S1", "S2", None])
    target = []
    for i, (key, system) in enumerate((k, s) for k in "ab" for s in ("S1", None, "S9")):
        row = {**random_rows(spec, [key], 1, i, null_keys=False)[0], "nm_sistema_origem": system}
        target.append({**row, **({spec.surrogate: 10 + i} if spec.surrogate else {})})
    merged = merge(frame(spark, spec.target_schema, target), frame(spark, schema_of(spec.insert_columns), rows), spec, RUN_TS)
    got, want = records(merged), row_by_row(target, rows, spec, RUN_TS)
    assert canon(got, spec.insert_columns) == canon(want, spec.insert_columns)
    assert sorted({r[ACTION] for r in got}) == ["insert", "keep", "update"]
    if spec.surrogate:
        assert sorted(r[spec.surrogate] for r in got) == list(range(10, 10 + len(want)))
        kept = {r[spec.surrogate]: (r[spec.key], r["nm_sistema_origem"]) for r in got if r[spec.surrogate] < 16}
        assert kept == {t[spec.surrogate]: (t[spec.key], t["nm_sistema_origem"]) for t in target}


@pytest.mark.parametrize("options, own", [({}, set()), ({"scope": ("nm_sistema_origem",)}, set()), ({"match": "case_insensitive"}, {"cd_sla"})])
def test_a_fold_shuffles_what_is_equal_in_a_group_once(spark, options, own):
    spec = ENTITIES["sla"].with_options(**options)
    rows = frame(spark, schema_of(spec.insert_columns), [{"cd_sla": "A", "nm_sla": "x", **OLD}])
    folded = fold(rows, spec)
    last = folded._jdf.queryExecution().analyzed().toString().split("max(struct(")[1].split("AS _last")[0]
    assert ("cd_sla" in last) == ("cd_sla" in own) and ("nm_sistema_origem" in last) == (not spec.scope)
    assert [r[spec.key] for r in records(folded)] == ["A"] and records(folded)[0]["nm_sistema_origem"] == "OLD"
