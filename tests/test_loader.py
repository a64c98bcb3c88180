from __future__ import annotations

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import OLD, RUN_TS, audit, canon, frame, records
from deskspark.operators.checks import AmbiguousLookup, DomainViolation
from deskspark.operators.upsert import merge
from deskspark.plans.entities import ENTITIES, load_levels
from deskspark.plans.loader import QUARANTINE, Loader, LoadFailed, report_frame
from deskspark.session import LEAN, lean_on_disk
from deskspark.sources.history import History
from deskspark.sources.store import TableStore
from deskspark.streaming.arrivals import load_arrivals

CNPJ = "00012345000199"


def desk(spark):
    """A small service desk with the edge cases of each kind."""
    rows = {
        "csat": [{"Id": 1, "Column1": "a", "Column2": "b"}],
        "sla": [{"id_sla": 1, "cd_sla": "S1", "nm_sla": "gold", "qt_meta_minutos": 60, **audit()}],
        "categoria": [{"id_categoria": 1, "cd_categoria": "C1", **audit()}],
        "cliente_organizacao": [
            {"id_cliente_organizacao": 1, "cd_cliente_organizacao": "O1", "nr_cnpj": CNPJ, **audit()}],
        "fila": [{"id_fila": 1, "cd_fila": "Q1", **audit()}, {"id_fila": 2, "cd_fila": "Q2", **audit()}],
        "solicitante": [
            {"id_solicitante": 1, "cd_solicitante": "P1", "id_cliente_organizacao": 1, **audit()},
            {"id_solicitante": 2, "cd_solicitante": "P2", "id_cliente_organizacao": 9, **audit()},
            {"id_solicitante": 3, "cd_solicitante": "P3", "id_cliente_organizacao": None, **audit()}],
        "analista": [
            {"id_analista": 1, "cd_analista": "A1", "id_fila_atual": 2, **audit()},
            {"id_analista": 2, "cd_analista": "A2", "id_fila_atual": None, **audit()}],
        "chamado": [
            {"id_chamado": 1, "nr_chamado": "T1", "ds_status_chamado": "OPEN", "id_analista_atual": 1,
             "id_reporter": 1, "id_categoria": 1, "id_cliente_organizacao": 1, "id_fila_atual": 7, **audit()},
            {"id_chamado": 2, "nr_chamado": "T2", "id_reporter": 2, "id_cliente_organizacao": 1, **audit()}],
        "chamado_status_historico": [
            {"id_chamado": 1, "ds_status_chamado": "OPEN", "id_fila": 2, **audit(record="H1")},
            {"id_chamado": 1, "ds_status_chamado": None, **audit(record="H2")},
            {"id_chamado": 2, "ds_status_chamado": "OPEN", **audit(record="H3")},
            {"id_chamado": 1, "ds_status_chamado": "CLOSED", **audit(record=None)}],
        "csat_avaliacao": [{"id_chamado": 1, "id_analista": 2, "nr_score": 5, **audit(record="E1")}],
        "chamado_sla": [{"id_chamado": 1, "id_sla": 1, "fl_breach": True, "qt_tempo_restante_minutos": -5,
                         **audit(record="K1")}],
    }
    return {name: frame(spark, ENTITIES[name].source_schema, r) for name, r in rows.items()}


def loader(spark, tmp_path, source, **options):
    return Loader(spark, source, TableStore(spark, str(tmp_path)), options.pop("run_ts", RUN_TS), **options)


def test_levels():
    assert load_levels() == [
        ["categoria", "cliente_organizacao", "csat", "fila", "sla"], ["analista", "solicitante"], ["chamado"],
        ["chamado_sla", "chamado_status_historico", "csat_avaliacao"],
    ]


def test_first_and_second_run(spark, tmp_path):
    run = loader(spark, tmp_path, desk(spark))
    reports = {r.entity: r for r in run.run_all()}
    counts = {n: (r.rows_read, r.rejected, r.inserted, r.updated, r.kept) for n, r in reports.items()}
    assert counts["solicitante"] == (3, 2, 1, 0, 0)
    assert counts["chamado"] == (2, 1, 1, 0, 0)
    assert counts["chamado_status_historico"] == (4, 1, 3, 0, 0)
    ticket = run.current("chamado").first()
    queue = {r.cd_fila: r.id_fila for r in run.current("fila").collect()}
    assert (ticket.id_fila_atual, ticket.id_chamado) == (None, 1)
    assert ticket.id_reporter == run.current("solicitante").first().id_solicitante
    assert run.current("cliente_organizacao").first().nr_cnpj == CNPJ
    assert {r.cd_analista: r.id_fila_atual for r in run.current("analista").collect()} == {"A1": queue["Q2"], "A2": None}
    before = {n: records(run.current(n)) for n in ENTITIES}
    frame_ = report_frame(spark, list(reports.values()))
    assert frame_.count() == 11 and frame_.filter("status = 'loaded'").count() == 11

    later = datetime(2024, 3, 1)
    again = loader(spark, tmp_path, desk(spark), run_ts=later)
    reports = {r.entity: r for r in again.run_all()}
    assert (reports["chamado_status_historico"].inserted, reports["chamado_status_historico"].updated) == (1, 2)
    for name, spec in ENTITIES.items():
        still = [c for c in spec.target_columns if c != "dt_atualizacao"]
        old, new = before[name], records(again.current(name))
        if name == "chamado_status_historico":
            assert len(new) == len(old) + 1
            old, new = ([r for r in rows if r["cd_registro_origem"]] for rows in (old, new))
        assert canon(old, still) == canon(new, still)
        if spec.stamped:
            assert {r["dt_atualizacao"] for r in new} == {later}


def test_rejects_and_history_are_kept(spark, tmp_path):
    history = History(spark, str(tmp_path / "history"))
    run = loader(spark, tmp_path / "store", desk(spark), keep_rejects=True, history=history)
    for name in ("cliente_organizacao", "solicitante"):
        run.load(name)
    spec = ENTITIES["solicitante"]
    lost = run.store.current("solicitante_rejects", T.StructType([*spec.source_schema.fields[1:],
                                                                  T.StructField("reason", T.StringType())]))
    assert sorted((r.cd_solicitante, r.reason) for r in lost.collect()) == [
        ("P2", "id_cliente_organizacao:source"), ("P3", "id_cliente_organizacao:source")]
    assert history.run_dates("solicitante") == [RUN_TS.date()]
    assert history.as_of("solicitante", spec.target_schema, RUN_TS.date()).count() == 1


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_repeated_source_ids_do_not_hide_rejects(spark, tmp_path, limit):
    source = desk(spark)
    orgs = source["cliente_organizacao"]
    source["cliente_organizacao"] = orgs.union(orgs).union(orgs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        run = loader(spark, tmp_path, source)
        reports = [run.load(name) for name in ("cliente_organizacao", "solicitante")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [(r.rows_read, r.rejected, r.inserted) for r in reports] == [(3, 0, 1), (3, 2, 1)]


def test_an_ambiguous_parent_is_refused_and_a_checked_one_remembered(spark, tmp_path):
    run = loader(spark, tmp_path, desk(spark))
    spec = ENTITIES["cliente_organizacao"]
    twice = frame(spark, spec.target_schema, [
        {"id_cliente_organizacao": i, "cd_cliente_organizacao": c, **OLD} for i, c in enumerate(["X", "X"])])
    run.store.publish(spec.name, run.store.write(spec.name, twice))
    with pytest.raises(AmbiguousLookup):
        run.load("solicitante")
    run.load(spec.name)
    assert run.store.pointer(spec.name)["unique_by"] is None
    with pytest.raises(AmbiguousLookup):
        run.load("solicitante")
    run.store.publish(spec.name, run.store.write(spec.name, twice.limit(1)))
    for _ in range(2):
        loader(spark, tmp_path, desk(spark)).load(spec.name)
        assert run.store.pointer(spec.name)["unique_by"] == "binary"
    assert loader(spark, tmp_path, desk(spark)).load("solicitante").inserted == 1


def test_second_run_repairs_an_optional_lookup(spark, tmp_path):
    source = desk(spark)
    late = {**source, "fila": source["fila"].filter("cd_fila = 'Q1'")}
    first = loader(spark, tmp_path, {**late, "analista": source["analista"]})
    first.run_all()
    assert {r.cd_analista: r.id_fila_atual for r in first.current("analista").collect()}["A1"] is None
    second = loader(spark, tmp_path, source)
    second.run_all()
    assert {r.cd_analista: r.id_fila_atual for r in second.current("analista").collect()}["A1"] == 2


def test_a_status_outside_the_domain_fails_the_load(spark, tmp_path):
    source = desk(spark)
    bad = frame(spark, ENTITIES["chamado_status_historico"].source_schema, [
        {"id_chamado": 1, "ds_status_chamado": "REOPENED", **audit("2023-01-01", "2023-01-01", record="H1")},
        {"id_chamado": 1, "ds_status_chamado": "OPEN", **audit(record="H1")}])
    run = loader(spark, tmp_path, {**source, "chamado_status_historico": bad})
    with pytest.raises(LoadFailed) as failure:
        run.run_all()
    assert isinstance(failure.value.errors["chamado_status_historico"], DomainViolation)
    assert {r.entity for r in failure.value.reports if r.status == "failed"} == {"chamado_status_historico"}
    assert run.current("chamado_status_historico").count() == 0
    assert run.current("chamado_sla").count() == 1


def test_a_bad_status_of_a_dropped_row_does_not_matter(spark, tmp_path):
    bad = frame(spark, ENTITIES["chamado_status_historico"].source_schema, [
        {"id_chamado": 99, "ds_status_chamado": "REOPENED", **audit(record="H1")}])
    run = loader(spark, tmp_path, {**desk(spark), "chamado_status_historico": bad})
    assert {r.entity: r.rejected for r in run.run_all()}["chamado_status_historico"] == 1


def test_quarantine(spark, tmp_path):
    source = desk(spark)
    bad = source["chamado_status_historico"].union(frame(spark, ENTITIES["chamado_status_historico"].source_schema, [
        {"id_chamado": 1, "ds_status_chamado": "REOPENED", **audit(record="H9")}]))
    run = loader(spark, tmp_path, {**source, "chamado_status_historico": bad}, on_violation=QUARANTINE)
    report = {r.entity: r for r in run.run_all()}["chamado_status_historico"]
    assert (report.rows_read, report.rejected, report.quarantined, report.inserted) == (5, 1, 1, 3)
    spec = ENTITIES["chamado_status_historico"]
    aside = run.store.current("chamado_status_historico_quarantine", spec.target_schema)
    assert [r.cd_registro_origem for r in aside.collect()] == ["H9"]


def test_a_failed_parent_stops_its_children(spark, tmp_path):
    source = desk(spark)
    source["fila"] = source["fila"].selectExpr(
        *(c if c != "id_fila" else "CAST(raise_error('lost') AS BIGINT) AS id_fila" for c in source["fila"].columns),
    ).withColumnRenamed("cd_fila", "cd_other")
    run = loader(spark, tmp_path, source)
    with pytest.raises(LoadFailed) as failure:
        run.run_all()
    status = {r.entity: r.status for r in failure.value.reports}
    assert status["fila"] == "failed"
    assert all(status[n] == "skipped" for n in ("analista", "chamado", "chamado_sla", "csat_avaliacao"))
    assert status["solicitante"] == status["sla"] == "loaded"


def test_empty_source(spark, tmp_path):
    empty = {n: frame(spark, s.source_schema, []) for n, s in ENTITIES.items()}
    run = loader(spark, tmp_path, empty)
    assert all((r.rows_read, r.inserted, r.kept) == (0, 0, 0) for r in run.run_all())
    run.store.publish("sla", run.store.write("sla", frame(spark, ENTITIES["sla"].target_schema,
                                                          [{"id_sla": 5, "cd_sla": "S", **OLD}])))
    assert run.load("sla").kept == 1


class Live(dict):
    live = True


def test_live_and_large_tables_give_the_same(spark, tmp_path):
    """Tables staged first, parents looked up through written pairs."""
    plain = loader(spark, tmp_path / "plain", desk(spark))
    plain.run_all()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = loader(spark, tmp_path / "large", Live(desk(spark)))
        large.run_all()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for name, spec in ENTITIES.items():
        assert canon(records(large.current(name)), spec.target_columns) == canon(
            records(plain.current(name)), spec.target_columns)


def test_stream_of_arrivals(spark, tmp_path):
    source = desk(spark)
    store = TableStore(spark, str(tmp_path / "store"))
    Loader(spark, source, store, RUN_TS).load("cliente_organizacao")
    spec = ENTITIES["solicitante"]
    arrivals = str(tmp_path / "arrivals")
    orgs = str(tmp_path / "orgs")
    source["cliente_organizacao"].write.parquet(orgs)

    def parents(session):
        return {"cliente_organizacao": session.read.schema(ENTITIES["cliente_organizacao"].source_schema).parquet(orgs)}

    def arrive(**values):
        row = {"id_solicitante": 1, "cd_solicitante": "P1", "id_cliente_organizacao": 1, **audit(), **values}
        frame(spark, spec.source_schema, [row]).coalesce(1).write.mode("append").parquet(arrivals)

    def drain():
        stream = spark.readStream.schema(spec.source_schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
        query = load_arrivals(stream, spec.name, parents, store, str(tmp_path / "checkpoint"), RUN_TS)
        query.awaitTermination()

    arrive(nm_solicitante="first")
    drain()
    arrive(nm_solicitante="second")
    arrive(cd_solicitante="P2", nm_solicitante="other")
    drain()
    got = {r.cd_solicitante: (r.id_solicitante, r.nm_solicitante, r.dt_atualizacao)
           for r in store.current(spec.name, spec.target_schema).collect()}
    assert got == {"P1": (1, "second", RUN_TS), "P2": (2, "other", datetime(2023, 12, 31))}
    assert store.pointer(spec.name)["version"].endswith("-000000000002")
    assert list(store.pointer(spec.name)["streams"].values()) == [2]


def test_buckets_spare_the_target_a_shuffle(spark, tmp_path):
    source = desk(spark)
    plain = loader(spark, tmp_path / "plain", source)
    plain.run_all()
    run = loader(spark, tmp_path / "buckets", source, bucketed=ENTITIES)
    run.run_all()
    for again in (True, False):
        for name, spec in ENTITIES.items():
            assert canon(records(run.current(name)), spec.target_columns) == canon(
                records(plain.current(name)), spec.target_columns)
        assert run.store.pointer("chamado")["buckets"] == 4
        assert "buckets" not in run.store.pointer("chamado_status_historico")
        if again:
            plain.run_all()
            run.run_all()
    spec = ENTITIES["csat_avaliacao"]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = []
        for store in (plain, run):
            rows = plain.current(spec.name).select(*spec.insert_columns)
            merged = merge(store.current(spec.name), rows, spec, RUN_TS, null_keys=False, target_null_keys=False)
            plans.append(merged._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert all("FullOuter" in p for p in plans)
    assert [p.count("Exchange hashpartitioning") for p in plans] == [2, 1]


def test_some_rows_leave_the_rest_of_a_plain_table_where_it_is(spark, tmp_path, monkeypatch):
    spec = ENTITIES["sla"]

    def rows(keys, **more):
        return frame(spark, spec.source_schema, [{"id_sla": i, "cd_sla": k, **more, **audit(record=f"R{i}")} for i, k in enumerate(keys)])

    first, some = rows([*(f"S{i}" for i in range(60)), None]), rows(["S3", "S3", "new", None], nm_sla="gold")
    seen = []

    def watched(target, *rest, **options):
        seen.append(target.count())
        return merge(target, *rest, **options)

    runs = [loader(spark, tmp_path / part, {"sla": first}) for part in ("some", "all")]
    for run in runs:
        run.load("sla")
    monkeypatch.setattr("deskspark.plans.loader.merge", watched)
    reports = [runs[0].load("sla", rows=some), loader(spark, tmp_path / "all", {"sla": some}).load("sla")]
    assert reports[0] == reports[1] and (reports[0].inserted, reports[0].updated, reports[0].kept) == (2, 1, 60)
    assert seen[0] < seen[1] == 61
    one, other = (canon(records(run.current("sla")), spec.target_columns) for run in runs)
    assert one == other and len(one) == 63


def test_tables_that_no_lookup_reads_are_written_smaller(spark, tmp_path):
    run = loader(spark, tmp_path, desk(spark))
    run.run_all()
    for name in ENTITIES:
        folder = tmp_path / name / f"v={run.store.pointer(name)['version']}"
        small = {p.name.endswith(".zstd.parquet") for p in folder.glob("*.parquet")}
        assert small == {name in ("csat", "chamado_status_historico", "csat_avaliacao", "chamado_sla")}


def tickets(spark):
    """A desk whose tickets and their facts repeat keys and source ids, and lack keys, parents and codes."""
    source = desk(spark)
    extra = {
        "chamado": [{"id_chamado": i, "nr_chamado": f"T{i % 40}" if i % 9 else None, "id_reporter": 1 + i % 3 // 2,
                     "id_analista_atual": i % 4 or None, "id_cliente_organizacao": 1, **audit(record=f"R{i}")} for i in range(3, 60)],
        "chamado_status_historico": [
            {"id_chamado": i % 70 or None, "ds_status_chamado": "OPEN", "qt_tempo_status_minutos": i, "id_analista_responsavel": i % 5 or None,
             **audit(record=f"H{i % 150}" if i % 11 else None)} for i in range(10, 300)],
        "csat_avaliacao": [{"id_chamado": i % 66, "nr_score": i % 5, "id_analista": i % 3 or None, **audit(record=f"E{i}")} for i in range(2, 90)],
        "chamado_sla": [{"id_chamado": i % 66, "id_sla": 1 + i % 2, **audit(record=f"K{i % 80}")} for i in range(2, 200)],
    }
    extra["chamado"].append(dict(extra["chamado"][4], nr_chamado="T77"))  # a source id of two tickets
    for name, rows in extra.items():
        source[name] = source[name].unionByName(frame(spark, ENTITIES[name].source_schema, rows))
    return source


@pytest.mark.parametrize("crowded", [0, 1000])
def test_tables_dealt_out_by_buckets_give_the_same(spark, tmp_path, monkeypatch, crowded):
    """A first run, and a second that updates; `crowded` 0 leaves every key to a shuffle although the tables are large."""
    source, limit = tickets(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plain = loader(spark, tmp_path / "plain", source)
    dealt = loader(spark, tmp_path / "dealt", source)
    runs = range(2 if crowded else 1)
    wanted = [plain.run_all() for _ in runs]
    columns, staged, plans = [], TableStore.stage_buckets, {}

    def watched(store, name, df, key, buckets):
        columns.append((name, key))
        return staged(store, name, df, key, buckets)

    def planned(target, rows, spec, *rest, **options):
        merged = merge(target, rows, spec, *rest, **options)
        plans[spec.name] = merged._jdf.queryExecution().executedPlan().toString()
        return merged

    monkeypatch.setattr("deskspark.plans.loader.ROWS_PER_BUCKET", 20)
    monkeypatch.setattr("deskspark.plans.loader.CROWDED", crowded)
    monkeypatch.setattr("deskspark.plans.loader.merge", planned)
    monkeypatch.setattr(TableStore, "stage_buckets", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [dealt.run_all() for _ in runs] == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for name, spec in ENTITIES.items():
        got, want = (canon(records(run.current(name)), spec.target_columns) for run in (dealt, plain))
        assert got == want and got
    moved = [("chamado_sla", "id_chamado"), ("link_chamado", "sid"), ("chamado_sla", "id_sla"), ("link_sla", "sid"),
             ("chamado_sla", "cd_registro_origem"), ("target_chamado_sla", "cd_registro_origem")]
    fact = [c for c in columns if c in moved and not c[0].startswith("link")]
    assert fact == ([c for c in moved if not c[0].startswith("link")] * 2 if crowded else [])
    for name in ("chamado_sla", "chamado_status_historico", "csat_avaliacao"):
        assert ("Exchange hashpartitioning" in plans[name]) == (not crowded)
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "dealt" / "_staging").iterdir()}
    assert left == {f"link_{lk.parent}" for spec in ENTITIES.values() for lk in spec.lookups}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("deskspark_") and str(tmp_path / "dealt") in str(
        spark.sql(f"DESCRIBE EXTENDED {t.name}").collect())]


def test_a_crowded_key_is_told_by_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("deskspark.plans.loader.ROWS_PER_BUCKET", 100)
    run = loader(spark, tmp_path, {})
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id < 300 THEN 7 ELSE id END AS hot", "CASE WHEN id >= 300 THEN id END AS gap")
    buckets = max(10, 2 * spark.sparkContext.defaultParallelism)
    assert (run._buckets_for(100), run._buckets_for(1000)) == (0, buckets)
    assert not run._crowded(rows, "id", buckets) and run._crowded(rows, "hot", buckets)
    assert run._crowded(rows, "gap", buckets) and not run._crowded(rows, "gap", buckets, without_null=True)
    assert not run._crowded(rows.limit(0), "id", buckets)


def test_settings_that_spare_disk_are_put_back(spark, tmp_path):
    before = {k: spark.conf.get(k, None) for k in LEAN}
    with lean_on_disk(spark):
        with lean_on_disk(spark):
            pass
        assert {k: spark.conf.get(k) for k in LEAN} == LEAN
    with pytest.raises(LoadFailed):
        loader(spark, tmp_path, {**desk(spark), "sla": desk(spark)["csat"]}).run_all()
    assert {k: spark.conf.get(k, None) for k in LEAN} == before


def test_shuffle_files_go_once_a_table_is_written(spark, tmp_path):
    def written():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    store, before = TableStore(spark, str(tmp_path)), written()
    with lean_on_disk(spark):
        store.write("t", spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # they are removed in the background
        if written() - before:
            time.sleep(0.1)
    assert not written() - before
