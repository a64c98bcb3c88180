"""Service-desk tables derived from the given star-schema tables.

Every table reads its whole base table. `SOURCE` is the operational side; `TARGET` is the
analytic side before the run: the same records with old attributes and ids of its own, some of
them under codes the source no longer uses. So each load updates, inserts and keeps rows, and
some lookups miss. The expressions are plain SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

RUN_TS = datetime(2024, 2, 1)

BASE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _ts(text: str) -> str:
    return f"CAST('{text}' AS @NTZ)"


def _audit(created: str, changed: str, system: str, record: str) -> list[str]:
    return [
        f"{created} AS dt_inclusao",
        f"{changed} AS dt_atualizacao",
        f"'{system}' AS nm_sistema_origem",
        f"{record} AS cd_registro_origem",
    ]


def _src(record: str) -> list[str]:
    return _audit(_ts("2023-06-01 00:00:00"), _ts("2023-12-31 00:00:00"), "SRC", record)


def _old(record: str) -> list[str]:
    return _audit(_ts("2022-01-01 00:00:00"), _ts("2022-06-01 00:00:00"), "OLD", record)


def _legacy(condition: str, code: str) -> str:
    return f"CASE WHEN {condition} THEN 'OLD-' || {code} ELSE {code} END"


_STATUS = (
    "CASE {0} % 6 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'PENDING' "
    "WHEN 3 THEN 'RESOLVED' WHEN 4 THEN 'CLOSED' ELSE 'CANCELLED' END"
)
_ORG_ID = "CAST(c_nationkey * 100 + ascii(substr(c_mktsegment, 1, 1)) AS BIGINT)"
_ORG_CODE = "'ORG-' || c_nationkey || '-' || c_mktsegment"
_SLA_CODE = "'SLA-' || p_partkey"
_CATEGORY_CODE = "'CAT-' || p_size"
_TICKET_NUMBER = "'CH' || o_orderkey"
_LOW_PRIORITY = "o_orderpriority = '5-LOW'"
_BRAND_ID = "CAST(substr(p_brand, 7) AS BIGINT)"
_TICKET_ORG = "CAST((o_custkey % 25) * 100 + ascii(substr('ABFHM', CAST(o_orderkey % 5 + 1 AS INT), 1)) AS BIGINT)"
_TICKET_ANALYST = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST((o_orderkey - o_orderkey % 130) / 130 AS BIGINT) END"
_DAY = "INTERVAL '1' DAY"
_HOUR = "INTERVAL '1' HOUR"
_LINE = "l_orderkey || '-' || l_linenumber"
_LINE_KEYS = ("l_orderkey", "l_linenumber")

# name -> (base table, grouping columns, select list)
SOURCE = {
    "csat": ("customer", (), ["c_custkey AS Id", "c_name AS Column1", "c_mktsegment AS Column2"]),
    "sla": ("part", (), [
        "p_partkey AS id_sla", f"{_SLA_CODE} AS cd_sla", "p_name AS nm_sla",
        "CAST(p_size * 60 AS BIGINT) AS qt_meta_minutos", "p_type AS ds_descricao", "p_size % 2 = 0 AS fl_ativo",
        *_src("'R' || p_partkey"),
    ]),
    "categoria": ("part", ("p_size",), [
        "CAST(p_size AS BIGINT) AS id_categoria", f"{_CATEGORY_CODE} AS cd_categoria", "min(p_name) AS nm_categoria",
        "max(p_type) AS ds_descricao", "true AS fl_ativo", *_src("'R' || p_size"),
    ]),
    "cliente_organizacao": ("customer", ("c_nationkey", "c_mktsegment"), [
        f"{_ORG_ID} AS id_cliente_organizacao", f"{_ORG_CODE} AS cd_cliente_organizacao",
        "min(c_name) AS nm_cliente_organizacao", f"lpad(CAST({_ORG_ID} AS STRING), 14, '0') AS nr_cnpj",
        "max(c_acctbal) > 0 AS fl_ativo", *_src(f"'R' || {_ORG_ID}"),
    ]),
    "fila": ("part", ("p_brand",), [
        f"{_BRAND_ID} AS id_fila", "p_brand AS cd_fila", "upper(p_brand) AS nm_fila",
        "min(p_name) AS ds_descricao", "true AS fl_ativo", *_src(f"'R' || {_BRAND_ID}"),
    ]),
    "solicitante": ("customer", (), [
        "c_custkey AS id_solicitante", "c_name AS cd_solicitante", "lower(c_name) AS nm_solicitante",
        "c_custkey || '@desk' AS ds_email",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE 'T' || c_custkey END AS ds_telefone",
        "c_acctbal >= 0 AS fl_ativo", f"{_ORG_ID} AS id_cliente_organizacao", *_src("'R' || c_custkey"),
    ]),
    "analista": ("supplier", (), [
        "s_suppkey AS id_analista", "s_name AS cd_analista", "lower(s_name) AS nm_analista",
        "s_suppkey || '@desk' AS ds_email", "'N' || (s_suppkey % 3 + 1) AS ds_nivel", "s_acctbal >= 0 AS fl_ativo",
        "s_suppkey % 30 AS id_fila_atual", *_src("'R' || s_suppkey"),
    ]),
    "chamado": ("orders", (), [
        "o_orderkey AS id_chamado", f"{_TICKET_NUMBER} AS nr_chamado", "o_orderstatus AS ds_tipo_chamado",
        f"{_STATUS.format('o_orderkey')} AS ds_status_chamado", "o_orderpriority AS ds_prioridade",
        "o_orderdate AS dt_criacao",
        "CASE WHEN o_orderkey % 6 < 3 THEN NULL "
        f"ELSE o_orderdate + CAST(o_orderkey % 10 AS INT) * {_DAY} END AS dt_resolucao",
        f"o_orderdate + {_DAY} AS dt_ultima_atualizacao", "'Ticket ' || o_orderkey AS ds_titulo",
        "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'About ' || CAST(floor(o_totalprice) AS BIGINT) END AS ds_descricao",
        f"{_TICKET_ANALYST} AS id_analista_atual", "o_custkey AS id_reporter", "o_orderkey % 60 AS id_categoria",
        f"{_TICKET_ORG} AS id_cliente_organizacao", "o_orderkey % 30 AS id_fila_atual",
        *_audit("o_orderdate", f"o_orderdate + {_DAY}", "SRC", "'R' || o_orderkey"),
    ]),
    "chamado_status_historico": ("lineitem", (), [
        f"{_STATUS.format('l_linenumber')} AS ds_status_chamado", "l_shipdate AS dt_inicio_status",
        f"l_shipdate + CAST(l_quantity AS INT) * {_HOUR} AS dt_fim_status",
        "CAST(l_quantity * 60 AS BIGINT) AS qt_tempo_status_minutos", "l_orderkey AS id_chamado",
        "l_suppkey + l_linenumber AS id_analista_responsavel", "l_partkey % 30 AS id_fila",
        *_audit("l_shipdate", f"l_shipdate + {_DAY}", "SRC", f"CASE WHEN l_suppkey = 9 THEN NULL ELSE {_LINE} END"),
    ]),
    "csat_avaliacao": ("events", (), [
        "CAST(1 + event_id % 5 AS INT) AS nr_score", "event_type AS ds_comentario", "ts AS dt_avaliacao",
        "event_id * 2 AS id_chamado", "user_id AS id_analista",
        *_audit("ts", f"ts + {_HOUR}", "SRC", "'E' || event_id"),
    ]),
    "chamado_sla": ("lineitem", (), [
        "l_quantity > 1 + l_partkey % 50 AS fl_breach",
        "CAST((1 + l_partkey % 50) * 60 - l_quantity * 60 AS BIGINT) AS qt_tempo_restante_minutos",
        "CAST(l_quantity * 60 AS BIGINT) AS qt_tempo_decorrido_minutos",
        "(1 + l_partkey % 50) * 60 AS qt_meta_minutos", "l_shipdate AS dt_referencia",
        "l_orderkey AS id_chamado", "l_partkey AS id_sla",
        *_audit("l_shipdate", f"l_shipdate + {_DAY}", "SRC", f"'S' || {_LINE}"),
    ]),
}

TARGET = {
    "csat": ("customer", (), [
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey + 1000000000 ELSE c_custkey END AS Id",
        "'old' AS Column1", "'old' AS Column2",
    ]),
    "sla": ("part", (), [
        "p_partkey + 9000000 AS id_sla", f"{_legacy('p_size > 40', _SLA_CODE)} AS cd_sla",
        "'old' AS nm_sla", "CAST(1 AS BIGINT) AS qt_meta_minutos", "'old' AS ds_descricao", "false AS fl_ativo",
        *_old("'R' || p_partkey"),
    ]),
    "categoria": ("part", ("p_size",), [
        "CAST(p_size + 3000000 AS BIGINT) AS id_categoria",
        f"{_legacy('p_size > 40', _CATEGORY_CODE)} AS cd_categoria",
        "'old' AS nm_categoria", "'old' AS ds_descricao", "false AS fl_ativo", *_old("'R' || p_size"),
    ]),
    "cliente_organizacao": ("customer", ("c_nationkey", "c_mktsegment"), [
        f"{_ORG_ID} + 4000000 AS id_cliente_organizacao",
        f"{_legacy('c_nationkey = 7', _ORG_CODE)} AS cd_cliente_organizacao",
        "'old' AS nm_cliente_organizacao", "'0' AS nr_cnpj", "false AS fl_ativo", *_old(f"'R' || {_ORG_ID}"),
    ]),
    "fila": ("part", ("p_brand",), [
        f"{_BRAND_ID} + 5000000 AS id_fila", f"{_legacy(_BRAND_ID + ' > 20', 'p_brand')} AS cd_fila",
        "'old' AS nm_fila", "'old' AS ds_descricao", "false AS fl_ativo", *_old(f"'R' || {_BRAND_ID}"),
    ]),
    "solicitante": ("customer", (), [
        "c_custkey + 2000000 AS id_solicitante",
        f"{_legacy('c_nationkey < 3', 'c_name')} AS cd_solicitante",
        "'old' AS nm_solicitante", "'old' AS ds_email", "'old' AS ds_telefone", "false AS fl_ativo",
        f"{_ORG_ID} + 4000000 AS id_cliente_organizacao", *_old("'R' || c_custkey"),
    ]),
    "analista": ("supplier", (), [
        "s_suppkey + 1000000 AS id_analista", f"{_legacy('s_nationkey < 6', 's_name')} AS cd_analista",
        "'old' AS nm_analista", "'old' AS ds_email", "'N0' AS ds_nivel", "false AS fl_ativo",
        "CAST(NULL AS BIGINT) AS id_fila_atual", *_old("'R' || s_suppkey"),
    ]),
    "chamado": ("orders", (), [
        "o_orderkey + 9000000 AS id_chamado",
        f"{_legacy(_LOW_PRIORITY, _TICKET_NUMBER)} AS nr_chamado",
        "'old' AS ds_tipo_chamado", "'OPEN' AS ds_status_chamado", "o_orderpriority AS ds_prioridade",
        "o_orderdate AS dt_criacao", "CAST(NULL AS @NTZ) AS dt_resolucao", "o_orderdate AS dt_ultima_atualizacao",
        "'old' AS ds_titulo", "'old' AS ds_descricao", "CAST(NULL AS BIGINT) AS id_analista_atual",
        "o_custkey + 2000000 AS id_reporter", "CAST(NULL AS BIGINT) AS id_categoria",
        f"{_TICKET_ORG} + 4000000 AS id_cliente_organizacao", "CAST(NULL AS BIGINT) AS id_fila_atual",
        *_old("'R' || o_orderkey"),
    ]),
    "chamado_status_historico": ("lineitem", _LINE_KEYS, [
        "'OPEN' AS ds_status_chamado", "min(l_shipdate) AS dt_inicio_status",
        "CAST(NULL AS @NTZ) AS dt_fim_status", "CAST(0 AS BIGINT) AS qt_tempo_status_minutos",
        "l_orderkey + 9000000 AS id_chamado", "CAST(NULL AS BIGINT) AS id_analista_responsavel",
        "CAST(NULL AS BIGINT) AS id_fila",
        *_old(f"CASE WHEN min(l_suppkey) = 9 THEN NULL ELSE {_legacy('l_linenumber = 3', _LINE)} END"),
    ]),
    "csat_avaliacao": ("events", (), [
        "CAST(0 AS INT) AS nr_score", "'old' AS ds_comentario", "ts AS dt_avaliacao",
        "event_id * 2 + 9000000 AS id_chamado", "CAST(NULL AS BIGINT) AS id_analista",
        *_old(_legacy("event_type = 'error'", "'E' || event_id")),
    ]),
    "chamado_sla": ("lineitem", _LINE_KEYS, [
        "false AS fl_breach", "CAST(0 AS BIGINT) AS qt_tempo_restante_minutos",
        "CAST(0 AS BIGINT) AS qt_tempo_decorrido_minutos", "CAST(0 AS BIGINT) AS qt_meta_minutos",
        "min(l_shipdate) AS dt_referencia", "l_orderkey + 9000000 AS id_chamado",
        "min(l_partkey) + 9000000 AS id_sla",
        *_old(_legacy("l_linenumber = 3", f"'S' || {_LINE}")),
    ]),
}


class Standins(Mapping):
    """name -> DataFrame, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: Mapping[str, tuple]):
        self.spark, self.sf_dir, self.tables = spark, sf_dir, tables

    def __getitem__(self, name: str) -> DataFrame:
        return derive(self.tables, name, base_table(self.spark, self.sf_dir, self.tables[name][0]))

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def derive(tables: Mapping[str, tuple], name: str, base: DataFrame) -> DataFrame:
    _, keys, columns = tables[name]
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    sql = f"SELECT {', '.join(columns)} FROM {{base}} {group}".replace("@NTZ", "TIMESTAMP_NTZ")
    return base.sparkSession.sql(sql, base=base)


def source(spark: SparkSession, sf_dir: str) -> Standins:
    return Standins(spark, sf_dir, SOURCE)


def target(spark: SparkSession, sf_dir: str) -> Standins:
    return Standins(spark, sf_dir, TARGET)


def duckdb_sql(tables: Mapping[str, tuple], name: str) -> str:
    base, keys, columns = tables[name]
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT {', '.join(columns)} FROM {base}{group}".replace("@NTZ", "TIMESTAMP")
