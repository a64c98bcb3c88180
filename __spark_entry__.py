
from __future__ import annotations

import sys
from collections import ChainMap
from collections.abc import Callable
from datetime import date, datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from deskspark.operators import checks, metrics  # noqa: E402
from deskspark.operators import resolve as rs  # noqa: E402
from deskspark.operators.surrogate import Ranges, new_key_ids  # noqa: E402
from deskspark.operators.upsert import ACTION, BOOKKEEPING, COUNT, fold, lacks_keys, merge, new_keys  # noqa: E402
from deskspark.plans.dashboards import DASHBOARDS, Dashboards  # noqa: E402
from deskspark.plans.entities import ENTITIES  # noqa: E402
from deskspark.plans.loader import Loader, codec_of, report_frame  # noqa: E402
from deskspark.session import lean_on_disk, new_workspace, spread  # noqa: E402
from deskspark.sources.files import FileSource, write_file  # noqa: E402
from deskspark.sources.history import History  # noqa: E402
from deskspark.sources.intervals import IntervalHistory  # noqa: E402
from deskspark.sources.store import TableStore, bucket_of  # noqa: E402
from deskspark.streaming.arrivals import load_arrivals  # noqa: E402
from samples import oracle, standin  # noqa: E402

try:
    from deskspark.llm import queries as llm
except ImportError as missing:  # the subpackage can be left out; an error inside it is not hidden
    if not (missing.name or "").startswith("deskspark.llm") and "deskspark.llm" not in str(missing):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_TS = standin.RUN_TS
SECOND_RUN_TS = datetime(2024, 2, 2)
FILE_FORMATS = ("parquet", "orc", "json", "csv")

Query = Callable[[SparkSession, str], DataFrame]


def _resolved(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source, target = standin.source(spark, sf), standin.target(spark, sf)
    return rs.resolve(source[name], ENTITIES[name], source, target)


def _merged(spark: SparkSession, sf: str, name: str, numbered: bool = True) -> DataFrame:
    """The load of `name`; `numbered=False` spares giving ids where nothing reads them."""
    spec = ENTITIES[name] if numbered else ENTITIES[name].with_options(surrogate=None)
    source, target = standin.source(spark, sf), standin.target(spark, sf)
    rows, old = source[name], target[name]
    keys = rs.survivors(rows, spec, source, target) if spec.surrogate else None
    return merge(old, rs.resolve(spread(rows, spec.key), spec, source, target), spec, RUN_TS, keys,
                 lacks_keys(rows, spec), lacks_keys(old, spec))


def _loaded(spark: SparkSession, sf: str, name: str, numbered: bool = True) -> DataFrame:
    return _merged(spark, sf, name, numbered).drop(*BOOKKEEPING)


def _load(name: str) -> Query:
    return lambda spark, sf: _loaded(spark, sf, name)


def _extract(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        source = standin.source(spark, sf)
        return rs.extract(source[name], ENTITIES[name], source)

    return query


def _resolve(name: str) -> Query:
    return lambda spark, sf: _resolved(spark, sf, name)


def upsert_actions(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "chamado", numbered=False).select("nr_chamado", F.col(ACTION).alias("acao"))


def upsert_audit(spark: SparkSession, sf: str) -> DataFrame:
    spec = ENTITIES["solicitante"]
    return _merged(spark, sf, spec.name).select(spec.key, spec.surrogate, *spec.audit, F.col(ACTION).alias("acao"))


def upsert_surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    spec = ENTITIES["solicitante"]
    target = standin.target(spark, sf)[spec.name]
    keys = new_keys(_resolved(spark, sf, spec.name), target, spec)
    return new_key_ids(keys, "_k", target, spec.surrogate).withColumnRenamed("_k", spec.key)


def upsert_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    folded = fold(_resolved(spark, sf, "chamado_sla"), ENTITIES["chamado_sla"])
    return folded.withColumnRenamed(COUNT, "qt_linhas").drop("_k", "dt_atualizacao", "nm_sistema_origem")


def upsert_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    merged = _merged(spark, sf, "chamado_status_historico")
    return merged.filter(F.col("cd_registro_origem").isNull()).select(
        "id_chamado", "ds_status_chamado", "dt_inicio_status", "qt_tempo_status_minutos", "dt_inclusao",
        "dt_atualizacao", F.col(ACTION).alias("acao"),
    )


def upsert_null_keys_with_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Requesters by name and market; those in debt have no code, so each is inserted with an id of its own, by ranges."""
    spec = ENTITIES["solicitante"].with_options(attributes=("cd_solicitante", "nm_solicitante"), lookups=(), audit=())
    rows = standin.base_table(spark, sf, "customer").selectExpr(
        "CASE WHEN c_acctbal >= 0 THEN c_name END AS cd_solicitante", "c_mktsegment AS nm_solicitante")
    target = standin.target(spark, sf)[spec.name].select(*spec.target_columns)
    store, parts = TableStore(spark, new_workspace(spark, "numbering")), int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = merge(target, rows, spec, RUN_TS, ranges=Ranges(parts, store.stage))
    return merged.select(*spec.target_columns, F.col(ACTION).alias("acao"))


def upsert_two_systems(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of two systems that use the same codes: one knows the target's records, the other's are all new."""
    spec = ENTITIES["csat_avaliacao"].with_options(scope=("nm_sistema_origem",))
    resolved = _resolved(spark, sf, spec.name)
    other = resolved.withColumns({"nm_sistema_origem": F.lit("OLD"), "nr_score": F.col("nr_score") + 10})
    merged = merge(standin.target(spark, sf)[spec.name], resolved.unionByName(other), spec, RUN_TS)
    return merged.select(*spec.target_columns, F.col(ACTION).alias("acao"))


def upsert_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The same source loaded twice; the second run reads what the first one published."""
    store = _seeded_store(spark, sf, "cliente_organizacao", "solicitante")
    source = standin.source(spark, sf)
    for run_ts in (RUN_TS, SECOND_RUN_TS):
        Loader(spark, source, store, run_ts).load("solicitante")
    return store.current("solicitante", ENTITIES["solicitante"].target_schema)


def resolve_rejects(spark: SparkSession, sf: str) -> DataFrame:
    source, target = standin.source(spark, sf), standin.target(spark, sf)
    lost = rs.rejects(source["chamado"], ENTITIES["chamado"], source, target)
    return lost.select("nr_chamado", "id_reporter", "id_cliente_organizacao", "reason")


def resolve_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Analysts whose queue was unknown get it once the queues are loaded."""
    source, target = standin.source(spark, sf), standin.target(spark, sf)
    spec = ENTITIES["analista"]
    queue_ids = "id_fila_antes", "id_fila_depois"
    before, after = (
        rs.resolve(source["analista"], spec, source, {"fila": queues}).select(
            spec.key, F.col("id_fila_atual").alias(name))
        for name, queues in zip(queue_ids, (target["fila"], _loaded(spark, sf, "fila")))
    )
    return before.join(after, spec.key)


def resolve_repair_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same by loading again only the analysts who waited for a queue."""
    spec, source = ENTITIES["analista"], standin.source(spark, sf)
    store = _seeded_store(spark, sf, *sorted({lk.parent for lk in spec.lookups}), spec.name)
    loader = Loader(spark, source, store, RUN_TS, bucketed=[spec.name], keep_unresolved=True)
    loader.load(spec.name)
    before = loader.current(spec.name).select(spec.key, F.col("id_fila_atual").alias("id_fila_antes"))
    loader.load("fila")
    loader.repair(spec.name)
    after = loader.current(spec.name).select(spec.key, F.col("id_fila_atual").alias("id_fila_depois"))
    return before.join(after, spec.key).join(source[spec.name].select(spec.key), spec.key, "left_semi")


def check_status_domain(spark: SparkSession, sf: str) -> DataFrame:
    """Line 7 of every order carries a status the history does not know; line 6 has none."""
    lines = standin.base_table(spark, sf, "lineitem")
    status = F.when(F.col("l_linenumber") == 7, "REOPENED").when(F.col("l_linenumber") != 6, "OPEN")
    rows = lines.select(
        F.expr("CASE WHEN l_suppkey = 9 THEN NULL ELSE l_orderkey || '-' || l_linenumber END").alias("cd_registro_origem"),
        F.col("l_orderkey").alias("id_chamado"), status.alias("ds_status_chamado"),
    )
    return checks.domain_violations(rows, ENTITIES["chamado_status_historico"])


def check_lookup_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Line numbers as natural keys: several line items share one."""
    lines = standin.base_table(spark, sf, "lineitem")
    table = lines.select(F.expr("l_orderkey || '-' || l_linenumber").alias("cd_sla"))
    return checks.ambiguous_keys(table, ENTITIES["sla"])


def _seeded_store(spark: SparkSession, sf: str, *names: str) -> TableStore:
    """A store holding the analytic side as it was before the run."""
    store = TableStore(spark, new_workspace(spark, "store"))
    target = standin.target(spark, sf)
    with lean_on_disk(spark):
        for name in names:
            store.publish(name, store.write(name, target[name], "before", codec=codec_of(name)))
    return store


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    store = _seeded_store(spark, sf, *ENTITIES)
    return report_frame(spark, Loader(spark, standin.source(spark, sf), store, RUN_TS).run_all())


def publish_swap(spark: SparkSession, sf: str) -> DataFrame:
    """The current version after a load took the place of the one before."""
    store = _seeded_store(spark, sf, "fila", "analista")
    loader = Loader(spark, standin.source(spark, sf), store, RUN_TS)
    loader.load("analista")
    return loader.current("analista")


def _load_from_files(fmt: str) -> Query:
    """Requesters and their organisations as folders of files whose contract is checked, loaded from there."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        spec, root, source = ENTITIES["solicitante"], new_workspace(spark, "files"), standin.source(spark, sf)
        for name in (spec.name, *(lk.parent for lk in spec.lookups)):
            write_file(source[name].select(*ENTITIES[name].source_schema.names), f"{root}/{name}", fmt)
        store = _seeded_store(spark, sf, "cliente_organizacao", spec.name)
        loader = Loader(spark, FileSource(spark, root, fmt), store, RUN_TS)
        loader.load(spec.name)
        return loader.current(spec.name)

    return query


def bucketed_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of the ticket table kept in buckets; the second shuffles only its source."""
    store = _seeded_store(spark, sf, *(lk.parent for lk in ENTITIES["chamado"].lookups), "chamado")
    source = standin.source(spark, sf)
    for run_ts in (RUN_TS, SECOND_RUN_TS):
        Loader(spark, source, store, run_ts, bucketed=["chamado"]).load("chamado")
    return store.current("chamado", ENTITIES["chamado"].target_schema)


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Customers arriving as a file stream, upserted as requesters."""
    spec = ENTITIES["solicitante"]
    store = _seeded_store(spark, sf, "cliente_organizacao", spec.name)
    arrivals = spark.readStream.schema(standin.BASE_SCHEMAS["customer"]).parquet(f"{sf}/customer*.parquet")
    query = load_arrivals(
        standin.derive(standin.SOURCE, spec.name, arrivals), spec.name, lambda session: standin.source(session, sf),
        store, new_workspace(spark, "stream"), RUN_TS,
    )
    query.awaitTermination()
    return store.current(spec.name, spec.target_schema)


def history_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of three days; the one valid on a day between the last two."""
    spec = ENTITIES["solicitante"]
    before, after = standin.target(spark, sf)[spec.name], _loaded(spark, sf, spec.name)
    history = History(spark, new_workspace(spark, "history"), "csv")
    for day, df in ((date(2024, 1, 31), before), (date(2024, 2, 1), after), (date(2024, 2, 5), before)):
        history.append(spec.name, df.select(*spec.target_columns), day)
    return history.as_of(spec.name, spec.target_schema, date(2024, 2, 3))


def history_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """The same three snapshots as intervals: rows that come, go and come back."""
    spec = ENTITIES["solicitante"]
    before, after = standin.target(spark, sf)[spec.name], _loaded(spark, sf, spec.name)
    history = IntervalHistory(spark, new_workspace(spark, "intervals"))
    for day, df in ((date(2024, 1, 31), before), (date(2024, 2, 1), after), (date(2024, 2, 5), before)):
        history.append(spec.name, df.select(*spec.target_columns), day)
    return history.intervals(spec.name, spec.target_schema)


def stream_two_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in debt and all others as two streams into one table kept in buckets; ids depend on who came first."""
    spec = ENTITIES["solicitante"]
    store, n = _seeded_store(spark, sf, "cliente_organizacao"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = standin.target(spark, sf)[spec.name].repartition(n, spec.key)
    store.publish(spec.name, store.write(spec.name, before, "before", n, spec.key), buckets=n, key=spec.key)
    arrivals = spark.readStream.schema(standin.BASE_SCHEMAS["customer"]).parquet(f"{sf}/customer*.parquet")
    for condition in ("c_acctbal < 0", "c_acctbal >= 0 OR c_acctbal IS NULL"):
        load_arrivals(
            standin.derive(standin.SOURCE, spec.name, arrivals.filter(condition)), spec.name, lambda session: standin.source(session, sf),
            store, new_workspace(spark, "stream"), RUN_TS,
        ).awaitTermination()
    return store.current(spec.name, spec.target_schema).drop(spec.surrogate)


def open_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.open_tickets(_loaded(spark, sf, "chamado", numbered=False), standin.target(spark, sf)["fila"])


def closed_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.closed_tickets(_loaded(spark, sf, "chamado", numbered=False))


def ticket_overview(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.ticket_overview(_loaded(spark, sf, "chamado", numbered=False))


def sla_breach(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.sla_breach(_loaded(spark, sf, "chamado_sla"), standin.target(spark, sf)["sla"])


def csat_by_analyst(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.csat_by_analyst(_loaded(spark, sf, "csat_avaliacao"), standin.target(spark, sf)["analista"])


def time_in_status(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.time_in_status(_loaded(spark, sf, "chamado_status_historico"))


def _refreshed(name: str) -> Query:
    """The dashboard kept up to date over two loads, each of half the keys' buckets."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        board, n = DASHBOARDS[name], int(spark.conf.get("spark.sql.shuffle.partitions"))
        spec = ENTITIES[board.fact]
        parents = {lk.parent for lk in spec.lookups}
        store, source = _seeded_store(spark, sf, *sorted(parents | set(board.names))), standin.source(spark, sf)
        # Whether keys are missing is asked of the written copy, as finding the rows of some tables shuffles their base table.
        plain = store.write(spec.name, standin.target(spark, sf)[spec.name], "plain")
        before = store.read(spec.name, {"version": plain}, spec.target_schema)
        if lacks_keys(before, spec):
            store.publish(spec.name, plain)
        else:
            store.publish(spec.name, store.write(spec.name, before.repartition(n, spec.key), "before", n, spec.key),
                          buckets=n, key=spec.key)
        boards, loader = Dashboards(spark, store), Loader(spark, source, store, RUN_TS, bucketed=[spec.name])
        boards.refresh(name)
        late = bucket_of(spec.key, n) < n // 2
        for rows in (source[spec.name].filter(~late), source[spec.name].filter(late)):
            loader.load(spec.name, rows=rows)
            boards.refresh(name)
        return boards.report(name)

    return query


_OTHERS: tuple[Query, ...] = (
    upsert_actions, upsert_audit, upsert_surrogate_ids, upsert_duplicate_keys, upsert_null_keys, upsert_null_keys_with_ids, upsert_two_systems, upsert_rerun,
    resolve_rejects, resolve_repair, resolve_repair_incremental, check_status_domain, check_lookup_unique, run_report, publish_swap,
    bucketed_rerun, stream_upsert, stream_two_sources, history_as_of, history_intervals, open_tickets, closed_tickets, ticket_overview, sla_breach, csat_by_analyst,
    time_in_status,
)


def entry(spark: SparkSession) -> DataFrame:
    """The ticket load: ten lookups, then the upsert."""
    return _loaded(spark, SMOKE_DIR, "chamado")


def queries() -> dict[str, Query]:
    joined = [name for name, spec in ENTITIES.items() if spec.lookups]
    return {
        **{f"load_{name}": _load(name) for name in ENTITIES},
        **{f"extract_{name}": _extract(name) for name in joined},
        **{f"resolve_{name}": _resolve(name) for name in joined},
        **{query.__name__: query for query in _OTHERS},
        **{f"refreshed_{name}": _refreshed(name) for name in DASHBOARDS},
        **{f"load_from_files_{fmt}": _load_from_files(fmt) for fmt in FILE_FORMATS},
        **(llm.QUERIES if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    joined = [name for name, spec in ENTITIES.items() if spec.lookups]
    return {
        **{f"load_{name}": oracle.load(name) for name in ENTITIES},
        **{f"extract_{name}": oracle.extract(name) for name in joined},
        **{f"resolve_{name}": oracle.resolved(name) for name in joined},
        **{query.__name__: getattr(oracle, query.__name__)() for query in _OTHERS
           if hasattr(oracle, query.__name__)},
        **{f"refreshed_{name}": getattr(oracle, name)() for name in DASHBOARDS},
        **{f"load_from_files_{fmt}": oracle.load("solicitante") for fmt in FILE_FORMATS},
        "publish_swap": oracle.load("analista"),
        "resolve_repair_incremental": oracle.resolve_repair(),
        "stream_upsert": oracle.load("solicitante"),
        **(llm.ORACLE if llm else {}),
    }
