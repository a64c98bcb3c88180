"""The eleven entities and the order their lookups impose."""

from __future__ import annotations

from graphlib import TopologicalSorter

from deskspark.plans.spec import EntitySpec, Lookup

# The statuses the status history accepts.
TICKET_STATUSES = ("OPEN", "IN_PROGRESS", "PENDING", "RESOLVED", "CLOSED", "CANCELLED")
OPEN_STATUSES = ("OPEN", "IN_PROGRESS", "PENDING")
CLOSED_STATUSES = ("RESOLVED", "CLOSED")

# Names of tables, columns and keys as they stand in the two schemas.
_SPECS = (
    EntitySpec("csat", key="Id", attributes=("Id", "Column1", "Column2"), audit=()),
    EntitySpec(
        "sla", key="cd_sla", surrogate="id_sla",
        attributes=("cd_sla", "nm_sla", "qt_meta_minutos", "ds_descricao", "fl_ativo"),
    ),
    EntitySpec(
        "categoria", key="cd_categoria", surrogate="id_categoria",
        attributes=("cd_categoria", "nm_categoria", "ds_descricao", "fl_ativo"),
    ),
    EntitySpec(
        "cliente_organizacao", key="cd_cliente_organizacao", surrogate="id_cliente_organizacao",
        attributes=("cd_cliente_organizacao", "nm_cliente_organizacao", "nr_cnpj", "fl_ativo"),
    ),
    EntitySpec(
        "fila", key="cd_fila", surrogate="id_fila",
        attributes=("cd_fila", "nm_fila", "ds_descricao", "fl_ativo"),
    ),
    EntitySpec(
        "solicitante", key="cd_solicitante", surrogate="id_solicitante",
        attributes=("cd_solicitante", "nm_solicitante", "ds_email", "ds_telefone", "fl_ativo"),
        lookups=(
            Lookup("cliente_organizacao", "id_cliente_organizacao", "cd_cliente_organizacao", required=True),
        ),
    ),
    EntitySpec(
        "analista", key="cd_analista", surrogate="id_analista",
        attributes=("cd_analista", "nm_analista", "ds_email", "ds_nivel", "fl_ativo"),
        lookups=(Lookup("fila", "id_fila_atual", "cd_fila_atual"),),
    ),
    EntitySpec(
        "chamado", key="nr_chamado", surrogate="id_chamado",
        attributes=(
            "nr_chamado", "ds_tipo_chamado", "ds_status_chamado", "ds_prioridade",
            "dt_criacao", "dt_resolucao", "dt_ultima_atualizacao", "ds_titulo", "ds_descricao",
        ),
        lookups=(
            Lookup("analista", "id_analista_atual", "cd_analista_atual"),
            Lookup("solicitante", "id_reporter", "cd_solicitante", required=True),
            Lookup("categoria", "id_categoria", "cd_categoria"),
            Lookup("cliente_organizacao", "id_cliente_organizacao", "cd_cliente_organizacao", required=True),
            Lookup("fila", "id_fila_atual", "cd_fila_atual"),
        ),
    ),
    EntitySpec(
        "chamado_status_historico", key="cd_registro_origem",
        attributes=("ds_status_chamado", "dt_inicio_status", "dt_fim_status", "qt_tempo_status_minutos"),
        lookups=(
            Lookup("chamado", "id_chamado", "nr_chamado", required=True),
            Lookup("analista", "id_analista_responsavel", "cd_analista_responsavel"),
            Lookup("fila", "id_fila", "cd_fila"),
        ),
        domain={"ds_status_chamado": TICKET_STATUSES},
    ),
    EntitySpec(
        "csat_avaliacao", key="cd_registro_origem",
        attributes=("nr_score", "ds_comentario", "dt_avaliacao"),
        lookups=(
            Lookup("chamado", "id_chamado", "nr_chamado", required=True),
            Lookup("analista", "id_analista", "cd_analista"),
        ),
    ),
    EntitySpec(
        "chamado_sla", key="cd_registro_origem",
        attributes=(
            "fl_breach", "qt_tempo_restante_minutos", "qt_tempo_decorrido_minutos",
            "qt_meta_minutos", "dt_referencia",
        ),
        lookups=(
            Lookup("chamado", "id_chamado", "nr_chamado", required=True),
            Lookup("sla", "id_sla", "cd_sla", required=True),
        ),
    ),
)

ENTITIES: dict[str, EntitySpec] = {spec.name: spec for spec in _SPECS}


def load_levels(specs: dict[str, EntitySpec] = ENTITIES) -> list[list[str]]:
    """Entities grouped so that every parent stands in an earlier group."""
    order = TopologicalSorter({n: {lk.parent for lk in s.lookups} & set(specs) for n, s in specs.items()})
    order.prepare()
    levels = []
    while order.is_active():
        ready = sorted(order.get_ready())
        levels.append(ready)
        order.done(*ready)
    return levels
