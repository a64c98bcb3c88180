from __future__ import annotations

import pytest

from conftest import canon, records
from deskspark.operators import checks
from deskspark.operators.resolve import extract, link, rejects, resolve, resolve_codes, survivors
from deskspark.plans.entities import ENTITIES
from samples import standin

SF = "/root/testdata/sf0.001"
JOINED = [n for n, s in ENTITIES.items() if s.lookups]


@pytest.fixture()
def tables(spark):
    return standin.source(spark, SF), standin.target(spark, SF)


@pytest.mark.parametrize("name", JOINED)
def test_every_way_gives_the_same_rows(spark, tables, name):
    source, target = tables
    spec = ENTITIES[name]
    plain = records(resolve(source[name], spec, source, target))
    two_steps = resolve_codes(extract(source[name], spec, source), spec, target)
    links = {lk.parent: link(source[lk.parent], target[lk.parent], ENTITIES[lk.parent]) for lk in spec.lookups}
    linked = resolve(source[name], spec, source, target, links=links)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = resolve(source[name], spec, source, target)
        assert "p0" not in large.columns
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        large = records(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    want = canon(plain, spec.insert_columns)
    assert want
    assert canon(records(survivors(source[name], spec, source, target)), [spec.key]) == canon(plain, [spec.key])
    assert canon(records(two_steps), spec.insert_columns) == want
    assert canon(records(linked), spec.insert_columns) == want
    assert canon(large, spec.insert_columns) == want


@pytest.mark.parametrize("name", JOINED)
def test_rejects_are_the_rest(tables, name):
    source, target = tables
    spec = ENTITIES[name]
    lost = rejects(source[name], spec, source, target).count()
    assert lost + resolve(source[name], spec, source, target).count() == source[name].count()
    if not any(lk.required for lk in spec.lookups):
        assert lost == 0


def test_reasons(spark):
    from conftest import frame

    spec = ENTITIES["chamado_sla"]
    side = lambda n, rows: frame(spark, ENTITIES[n].target_schema, rows)
    source = {
        "chamado": side("chamado", [{"id_chamado": 1, "nr_chamado": "A"}, {"id_chamado": 2, "nr_chamado": "B"},
                                    {"id_chamado": 3}]),
        "sla": side("sla", [{"id_sla": 1, "cd_sla": "S"}]),
    }
    target = {
        "chamado": side("chamado", [{"id_chamado": 11, "nr_chamado": "A"}, {"id_chamado": 12}]),
        "sla": side("sla", [{"id_sla": 21, "cd_sla": "S"}]),
    }
    rows = side("chamado_sla", [
        {"cd_registro_origem": k, "id_chamado": c, "id_sla": s}
        for k, c, s in [("ok", 1, 1), ("new parent", 2, 1), ("dangling", 9, 9), ("null", None, 1), ("no code", 3, 1)]
    ])
    got = {r.cd_registro_origem: r.reason for r in rejects(rows, spec, source, target).collect()}
    assert got == {
        "new parent": "id_chamado:target", "dangling": "id_chamado:source,id_sla:source",
        "null": "id_chamado:source", "no code": "id_chamado:target",
    }
    done = resolve(rows, spec, source, target).collect()
    assert [(r.cd_registro_origem, r.id_chamado, r.id_sla) for r in done] == [("ok", 11, 21)]


def test_small_parents_need_no_shuffle(tables):
    source, target = tables
    plan = resolve(source["analista"], ENTITIES["analista"], source, target)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_large_parent_shuffles_the_wide_rows_once(spark, tables):
    """The ticket is looked up through a pair of narrow tables: one join on the wide side."""
    source, target = tables
    spec = ENTITIES["chamado_sla"].with_options(lookups=ENTITIES["chamado_sla"].lookups[:1])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = resolve(source["chamado_sla"], spec, source, target)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert text.count("SortMergeJoin") == 2
    wide = [line for line in text.splitlines() if "Exchange" in line]
    assert len(wide) == 4  # two narrow sides, their pair, and the rows


def test_ambiguous_lookup_is_refused(spark):
    from conftest import frame

    spec = ENTITIES["sla"]
    table = frame(spark, spec.target_schema, [{"id_sla": i, "cd_sla": c} for i, c in enumerate(["a", "a", "b", None, None])])
    assert [tuple(r) for r in checks.ambiguous_keys(table, spec).collect()] == [("a", 2)]
    with pytest.raises(checks.AmbiguousLookup):
        checks.require_unambiguous(table, spec)


def test_domain(spark):
    from conftest import frame

    spec = ENTITIES["chamado_status_historico"]
    table = frame(spark, spec.target_schema, [{"ds_status_chamado": s} for s in ("OPEN", None, "REOPENED", "open")])
    assert sorted(r.ds_status_chamado for r in checks.domain_violations(table, spec).collect()) == ["REOPENED", "open"]
    assert checks.within_domain(table, spec).count() == 2


def test_rows_of_a_hot_parent_are_split(spark):
    """A third of the answers belong to one ticket, another third to no analyst."""

    spec = ENTITIES["csat_avaliacao"]
    number = 300_000
    rows = spark.range(0, number, 1, 16).selectExpr(
        "'E' || id AS cd_registro_origem", "CAST(id % 5 AS INT) AS nr_score", "repeat('c', 20) AS ds_comentario",
        "TIMESTAMP_NTZ '2023-01-01 00:00:00' AS dt_avaliacao", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 5000 END AS id_chamado",
        "CASE WHEN id % 3 = 1 THEN NULL ELSE id % 5000 END AS id_analista",
        *(f"TIMESTAMP_NTZ '2023-01-01 00:00:00' AS {c}" for c in ("dt_inclusao", "dt_atualizacao")), "'S' AS nm_sistema_origem",
    )
    parents = {
        n: spark.range(5000).selectExpr(f"id AS {ENTITIES[n].surrogate}", f"'K' || id AS {ENTITIES[n].key}")
        for n in ("chamado", "analista")
    }
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        execution = resolve(rows, spec, parents, parents)._jdf.queryExecution()
        assert execution.toRdd().count() == number
        plan = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true) [id_chamado" in plan
    assert "SortMergeJoin(skew=true) [id_analista" in plan
