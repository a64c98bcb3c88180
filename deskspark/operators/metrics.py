"""Dashboard numbers on loaded tables. Rows are aggregated first and named afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskspark.plans.entities import CLOSED_STATUSES, OPEN_STATUSES

MINUTES = 60.0


def open_tickets(chamado: DataFrame, fila: DataFrame) -> DataFrame:
    """Open tickets by queue and priority."""
    counts = (
        chamado.filter(F.col("ds_status_chamado").isin(*OPEN_STATUSES))
        .groupBy("id_fila_atual", "ds_prioridade")
        .agg(F.count(F.lit(1)).alias("qt_chamados"))
    )
    names = fila.select(F.col("id_fila").alias("id_fila_atual"), "cd_fila")
    return counts.join(names, "id_fila_atual", "left").select("cd_fila", "ds_prioridade", "qt_chamados")


def closed_tickets(chamado: DataFrame) -> DataFrame:
    """Resolved and closed tickets per month, with the mean minutes to resolve."""
    month = F.date_trunc("month", "dt_resolucao").cast("timestamp_ntz")
    minutes = F.timestamp_diff("SECOND", F.col("dt_criacao"), F.col("dt_resolucao")) / MINUTES
    return (
        chamado.filter(F.col("ds_status_chamado").isin(*CLOSED_STATUSES) & F.col("dt_resolucao").isNotNull())
        .groupBy(month.alias("dt_mes"))
        .agg(F.count(F.lit(1)).alias("qt_chamados"), F.round(F.avg(minutes), 6).alias("qt_media_minutos"))
    )


def ticket_overview(chamado: DataFrame) -> DataFrame:
    """Counts by status and priority with all subtotals."""
    return (
        chamado.cube("ds_status_chamado", "ds_prioridade")
        .agg(F.grouping_id().cast("long").alias("nr_nivel"), F.count(F.lit(1)).alias("qt_chamados"))
        .select("ds_status_chamado", "ds_prioridade", "nr_nivel", "qt_chamados")
    )


def sla_breach(chamado_sla: DataFrame, sla: DataFrame) -> DataFrame:
    """Breaches and their share per SLA; those of an SLA without a name row have no name."""
    breach = F.col("fl_breach").cast("int")
    counts = chamado_sla.groupBy("id_sla").agg(
        F.count(F.lit(1)).alias("qt_registros"),
        F.coalesce(F.sum(breach), F.lit(0)).cast("long").alias("qt_breach"),
        F.round(F.avg(breach), 6).alias("pc_breach"),
    )
    names = sla.select("id_sla", "cd_sla", "nm_sla")
    return counts.join(names, "id_sla", "left").select("cd_sla", "nm_sla", "qt_registros", "qt_breach", "pc_breach")


def csat_by_analyst(csat_avaliacao: DataFrame, analista: DataFrame) -> DataFrame:
    """Responses and mean score per analyst; answers without an analyst form one row."""
    counts = csat_avaliacao.groupBy("id_analista").agg(
        F.count("nr_score").alias("qt_respostas"), F.round(F.avg("nr_score"), 6).alias("nr_media")
    )
    names = analista.select("id_analista", "cd_analista")
    return counts.join(names, "id_analista", "left").select("cd_analista", "qt_respostas", "nr_media")


def time_in_status(historico: DataFrame) -> DataFrame:
    """Total minutes per status."""
    return historico.groupBy("ds_status_chamado").agg(
        F.count(F.lit(1)).alias("qt_registros"),
        F.sum("qt_tempo_status_minutos").alias("qt_total_minutos"),
    )


# The same numbers in two steps, for tables that change: tallies of whole numbers, which can be added to and
# taken from, and what is read off them. `qt_linhas` counts a group's rows.


def _count():
    return F.count(F.lit(1)).alias("qt_linhas")


def _total(column, name: str):
    return F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(name)


def _mean(total: str, n: str):
    return F.round(F.col(total) / F.nullif(F.col(n), F.lit(0)), 6)


def tally_open_tickets(chamado: DataFrame) -> DataFrame:
    is_open = F.col("ds_status_chamado").isin(*OPEN_STATUSES)
    return chamado.filter(is_open).groupBy("id_fila_atual", "ds_prioridade").agg(_count())


def read_open_tickets(tally: DataFrame, fila: DataFrame) -> DataFrame:
    names = fila.select(F.col("id_fila").alias("id_fila_atual"), "cd_fila")
    return tally.join(names, "id_fila_atual", "left").select("cd_fila", "ds_prioridade", F.col("qt_linhas").alias("qt_chamados"))


def tally_closed_tickets(chamado: DataFrame) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.col("dt_criacao"), F.col("dt_resolucao"))
    closed = chamado.filter(F.col("ds_status_chamado").isin(*CLOSED_STATUSES) & F.col("dt_resolucao").isNotNull())
    return closed.groupBy(F.date_trunc("month", "dt_resolucao").cast("timestamp_ntz").alias("dt_mes")).agg(
        _count(), F.count(seconds).alias("qt_medidos"), _total(seconds, "qt_segundos"))


def read_closed_tickets(tally: DataFrame) -> DataFrame:
    minutes = F.col("qt_segundos") / MINUTES / F.nullif(F.col("qt_medidos"), F.lit(0))
    return tally.select("dt_mes", F.col("qt_linhas").alias("qt_chamados"), F.round(minutes, 6).alias("qt_media_minutos"))


def tally_ticket_overview(chamado: DataFrame) -> DataFrame:
    return chamado.groupBy("ds_status_chamado", "ds_prioridade").agg(_count())


def read_ticket_overview(tally: DataFrame) -> DataFrame:
    """Of an empty table the grand total is 0, as it is for the tickets themselves."""
    return (
        tally.cube("ds_status_chamado", "ds_prioridade")
        .agg(F.grouping_id().cast("long").alias("nr_nivel"), _total("qt_linhas", "qt_chamados"))
        .select("ds_status_chamado", "ds_prioridade", "nr_nivel", "qt_chamados")
    )


def tally_sla_breach(chamado_sla: DataFrame) -> DataFrame:
    return chamado_sla.groupBy("id_sla").agg(
        _count(), F.count("fl_breach").alias("qt_medidos"), _total(F.col("fl_breach").cast("int"), "qt_breach"))


def read_sla_breach(tally: DataFrame, sla: DataFrame) -> DataFrame:
    return tally.join(sla.select("id_sla", "cd_sla", "nm_sla"), "id_sla", "left").select(
        "cd_sla", "nm_sla", F.col("qt_linhas").alias("qt_registros"), "qt_breach",
        _mean("qt_breach", "qt_medidos").alias("pc_breach"))


def tally_csat_by_analyst(csat_avaliacao: DataFrame) -> DataFrame:
    return csat_avaliacao.groupBy("id_analista").agg(
        _count(), F.count("nr_score").alias("qt_respostas"), _total("nr_score", "nr_soma"))


def read_csat_by_analyst(tally: DataFrame, analista: DataFrame) -> DataFrame:
    return tally.join(analista.select("id_analista", "cd_analista"), "id_analista", "left").select(
        "cd_analista", "qt_respostas", _mean("nr_soma", "qt_respostas").alias("nr_media"))


def tally_time_in_status(historico: DataFrame) -> DataFrame:
    minutes = "qt_tempo_status_minutos"
    return historico.groupBy("ds_status_chamado").agg(_count(), F.count(minutes).alias("qt_medidos"), _total(minutes, "qt_minutos"))


def read_time_in_status(tally: DataFrame) -> DataFrame:
    return tally.select("ds_status_chamado", F.col("qt_linhas").alias("qt_registros"),
                        F.when(F.col("qt_medidos") > 0, F.col("qt_minutos")).alias("qt_total_minutos"))
