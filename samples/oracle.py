"""The expected results as SQL, written apart from the Spark code they check.

Only the stand-in tables share text with it, being the input of both.
"""

from __future__ import annotations

from samples.standin import SOURCE, TARGET, duckdb_sql

RUN = "TIMESTAMP '2024-02-01 00:00:00'"
SECOND_RUN = "TIMESTAMP '2024-02-02 00:00:00'"
AUDIT = "dt_inclusao, dt_atualizacao, nm_sistema_origem, cd_registro_origem"

# Key, surrogate id and the columns overwritten by an update, as they stand in the two schemas.
SHAPE = {
    "csat": ("Id", None, "Column1, Column2"),
    "sla": ("cd_sla", "id_sla",
            "nm_sla, qt_meta_minutos, ds_descricao, fl_ativo, nm_sistema_origem, cd_registro_origem"),
    "categoria": ("cd_categoria", "id_categoria",
                  "nm_categoria, ds_descricao, fl_ativo, nm_sistema_origem, cd_registro_origem"),
    "cliente_organizacao": ("cd_cliente_organizacao", "id_cliente_organizacao",
                            "nm_cliente_organizacao, nr_cnpj, fl_ativo, nm_sistema_origem, cd_registro_origem"),
    "fila": ("cd_fila", "id_fila", "nm_fila, ds_descricao, fl_ativo, nm_sistema_origem, cd_registro_origem"),
    "solicitante": ("cd_solicitante", "id_solicitante",
                    "id_cliente_organizacao, nm_solicitante, ds_email, ds_telefone, fl_ativo, "
                    "nm_sistema_origem, cd_registro_origem"),
    "analista": ("cd_analista", "id_analista",
                 "nm_analista, ds_email, ds_nivel, id_fila_atual, fl_ativo, nm_sistema_origem, cd_registro_origem"),
    "chamado": ("nr_chamado", "id_chamado",
                "ds_tipo_chamado, ds_status_chamado, ds_prioridade, dt_criacao, dt_resolucao, "
                "dt_ultima_atualizacao, id_analista_atual, id_reporter, id_categoria, id_cliente_organizacao, "
                "id_fila_atual, ds_titulo, ds_descricao, nm_sistema_origem, cd_registro_origem"),
    "chamado_status_historico": ("cd_registro_origem", None,
                                 "id_chamado, ds_status_chamado, dt_inicio_status, dt_fim_status, "
                                 "qt_tempo_status_minutos, id_analista_responsavel, id_fila, nm_sistema_origem"),
    "csat_avaliacao": ("cd_registro_origem", None,
                       "id_chamado, id_analista, nr_score, ds_comentario, dt_avaliacao, nm_sistema_origem"),
    "chamado_sla": ("cd_registro_origem", None,
                    "id_chamado, id_sla, fl_breach, qt_tempo_restante_minutos, qt_tempo_decorrido_minutos, "
                    "qt_meta_minutos, dt_referencia, nm_sistema_origem"),
}

# Fixed values too, names of columns: the arrival order of rows with the same key, the earliest first.
ORDER = {
    "chamado_status_historico": "dt_atualizacao, dt_inclusao, ds_status_chamado, dt_inicio_status, dt_fim_status, "
                                "qt_tempo_status_minutos, id_chamado, id_analista_responsavel, id_fila",
    "chamado_sla": "dt_atualizacao, dt_inclusao, fl_breach, qt_tempo_restante_minutos, qt_tempo_decorrido_minutos, "
                   "qt_meta_minutos, dt_referencia, id_chamado, id_sla",
}

EXTRACT = {
    "solicitante": """
        SELECT s.cd_solicitante, s.nm_solicitante, s.ds_email, s.ds_telefone, s.fl_ativo,
               co.cd_cliente_organizacao, s.dt_inclusao, s.dt_atualizacao, s.nm_sistema_origem, s.cd_registro_origem
        FROM src_solicitante s
        JOIN src_cliente_organizacao co ON s.id_cliente_organizacao = co.id_cliente_organizacao""",
    "analista": """
        SELECT a.cd_analista, a.nm_analista, a.ds_email, a.ds_nivel, a.fl_ativo, f.cd_fila AS cd_fila_atual,
               a.dt_inclusao, a.dt_atualizacao, a.nm_sistema_origem, a.cd_registro_origem
        FROM src_analista a LEFT JOIN src_fila f ON a.id_fila_atual = f.id_fila""",
    "chamado": """
        SELECT t.nr_chamado, t.ds_tipo_chamado, t.ds_status_chamado, t.ds_prioridade, t.dt_criacao, t.dt_resolucao,
               t.dt_ultima_atualizacao, t.ds_titulo, t.ds_descricao, an.cd_analista AS cd_analista_atual,
               so.cd_solicitante, ca.cd_categoria, org.cd_cliente_organizacao, fi.cd_fila AS cd_fila_atual,
               t.dt_inclusao, t.dt_atualizacao, t.nm_sistema_origem, t.cd_registro_origem
        FROM src_chamado t
        JOIN src_solicitante so ON t.id_reporter = so.id_solicitante
        JOIN src_cliente_organizacao org ON t.id_cliente_organizacao = org.id_cliente_organizacao
        LEFT JOIN src_analista an ON t.id_analista_atual = an.id_analista
        LEFT JOIN src_categoria ca ON t.id_categoria = ca.id_categoria
        LEFT JOIN src_fila fi ON t.id_fila_atual = fi.id_fila""",
    "chamado_status_historico": """
        SELECT h.ds_status_chamado, h.dt_inicio_status, h.dt_fim_status, h.qt_tempo_status_minutos, t.nr_chamado,
               an.cd_analista AS cd_analista_responsavel, fi.cd_fila,
               h.dt_inclusao, h.dt_atualizacao, h.nm_sistema_origem, h.cd_registro_origem
        FROM src_chamado_status_historico h
        JOIN src_chamado t ON h.id_chamado = t.id_chamado
        LEFT JOIN src_analista an ON h.id_analista_responsavel = an.id_analista
        LEFT JOIN src_fila fi ON h.id_fila = fi.id_fila""",
    "csat_avaliacao": """
        SELECT r.nr_score, r.ds_comentario, r.dt_avaliacao, t.nr_chamado, an.cd_analista,
               r.dt_inclusao, r.dt_atualizacao, r.nm_sistema_origem, r.cd_registro_origem
        FROM src_csat_avaliacao r
        JOIN src_chamado t ON r.id_chamado = t.id_chamado
        LEFT JOIN src_analista an ON r.id_analista = an.id_analista""",
    "chamado_sla": """
        SELECT k.fl_breach, k.qt_tempo_restante_minutos, k.qt_tempo_decorrido_minutos, k.qt_meta_minutos,
               k.dt_referencia, t.nr_chamado, sl.cd_sla,
               k.dt_inclusao, k.dt_atualizacao, k.nm_sistema_origem, k.cd_registro_origem
        FROM src_chamado_sla k
        JOIN src_chamado t ON k.id_chamado = t.id_chamado
        JOIN src_sla sl ON k.id_sla = sl.id_sla""",
}

RESOLVE = {
    "solicitante": """
        SELECT x.* EXCLUDE (cd_cliente_organizacao), o2.id_cliente_organizacao FROM ext_solicitante x
        JOIN tgt_cliente_organizacao o2 ON o2.cd_cliente_organizacao = x.cd_cliente_organizacao""",
    "analista": """
        SELECT x.* EXCLUDE (cd_fila_atual), f2.id_fila AS id_fila_atual FROM ext_analista x
        LEFT JOIN tgt_fila f2 ON f2.cd_fila = x.cd_fila_atual""",
    "chamado": """
        SELECT x.* EXCLUDE (cd_analista_atual, cd_solicitante, cd_categoria, cd_cliente_organizacao, cd_fila_atual),
               a2.id_analista AS id_analista_atual, s2.id_solicitante AS id_reporter, c2.id_categoria,
               o2.id_cliente_organizacao, f2.id_fila AS id_fila_atual
        FROM ext_chamado x
        JOIN tgt_solicitante s2 ON s2.cd_solicitante = x.cd_solicitante
        JOIN tgt_cliente_organizacao o2 ON o2.cd_cliente_organizacao = x.cd_cliente_organizacao
        LEFT JOIN tgt_analista a2 ON a2.cd_analista = x.cd_analista_atual
        LEFT JOIN tgt_categoria c2 ON c2.cd_categoria = x.cd_categoria
        LEFT JOIN tgt_fila f2 ON f2.cd_fila = x.cd_fila_atual""",
    "chamado_status_historico": """
        SELECT x.* EXCLUDE (nr_chamado, cd_analista_responsavel, cd_fila), t2.id_chamado,
               a2.id_analista AS id_analista_responsavel, f2.id_fila
        FROM ext_chamado_status_historico x
        JOIN tgt_chamado t2 ON t2.nr_chamado = x.nr_chamado
        LEFT JOIN tgt_analista a2 ON a2.cd_analista = x.cd_analista_responsavel
        LEFT JOIN tgt_fila f2 ON f2.cd_fila = x.cd_fila""",
    "csat_avaliacao": """
        SELECT x.* EXCLUDE (nr_chamado, cd_analista), t2.id_chamado, a2.id_analista
        FROM ext_csat_avaliacao x
        JOIN tgt_chamado t2 ON t2.nr_chamado = x.nr_chamado
        LEFT JOIN tgt_analista a2 ON a2.cd_analista = x.cd_analista""",
    "chamado_sla": """
        SELECT x.* EXCLUDE (nr_chamado, cd_sla), t2.id_chamado, s2.id_sla
        FROM ext_chamado_sla x
        JOIN tgt_chamado t2 ON t2.nr_chamado = x.nr_chamado
        JOIN tgt_sla s2 ON s2.cd_sla = x.cd_sla""",
}

PARENTS = {
    "solicitante": ["cliente_organizacao"],
    "analista": ["fila"],
    "chamado": ["analista", "solicitante", "categoria", "cliente_organizacao", "fila"],
    "chamado_status_historico": ["chamado", "analista", "fila"],
    "csat_avaliacao": ["chamado", "analista"],
    "chamado_sla": ["chamado", "sla"],
}


def _split(columns: str) -> list[str]:
    return [c.strip() for c in columns.split(",")]


def _insert_columns(name: str) -> list[str]:
    key, _, updated = SHAPE[name]
    stamps = [] if name == "csat" else ["dt_inclusao", "dt_atualizacao"]
    return [key, *_split(updated), *stamps]


def _target_columns(name: str) -> list[str]:
    surrogate = SHAPE[name][1]
    return [*([surrogate] if surrogate else []), *_insert_columns(name)]


def _input_ctes(name: str) -> dict[str, str]:
    """Source, target, extract and resolved rows of an entity."""
    tables = {}
    for parent in PARENTS.get(name, []):
        tables[f"src_{parent}"] = duckdb_sql(SOURCE, parent)
        tables[f"tgt_{parent}"] = duckdb_sql(TARGET, parent)
    tables[f"src_{name}"] = duckdb_sql(SOURCE, name)
    tables[f"tgt_{name}"] = duckdb_sql(TARGET, name)
    if name in EXTRACT:
        tables[f"ext_{name}"] = EXTRACT[name]
        tables[f"res_{name}"] = RESOLVE[name]
    else:
        tables[f"res_{name}"] = f"SELECT {', '.join(_insert_columns(name))} FROM src_{name}"
    return tables


def _merge_ctes(name: str, run: str = RUN) -> dict[str, str]:
    """fold_, new_ and out_ of an entity, on top of its res_ and tgt_."""
    key, surrogate, updated = SHAPE[name]
    stamped = name != "csat"
    order = _split(ORDER.get(name, key))
    up = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    down = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    first = f", first_value(dt_inclusao) OVER (PARTITION BY {key} ORDER BY {up}) AS first_inclusao" if stamped else ""
    ctes = {
        f"fold_{name}": f"""
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {down}) AS place,
                                  count(*) OVER (PARTITION BY {key}) AS n{first}
                           FROM res_{name} WHERE {key} IS NOT NULL) WHERE place = 1"""
    }
    ids = null_id = ""
    id_join = ""
    if surrogate:
        ctes[f"new_{name}"] = f"""
            SELECT {key}, (SELECT coalesce(max({surrogate}), 0) FROM tgt_{name})
                   + row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {key}) AS new_id
            FROM fold_{name} WHERE {key} NOT IN (SELECT {key} FROM tgt_{name} WHERE {key} IS NOT NULL)"""
        ids = f"CASE WHEN t.mark THEN t.{surrogate} ELSE nw.new_id END AS {surrogate}, "
        id_join = f"LEFT JOIN new_{name} nw ON nw.{key} = s.{key}"
        null_id = f"CAST(NULL AS BIGINT) AS {surrogate}, "
    columns = [f"CASE WHEN t.mark THEN t.{key} ELSE s.{key} END AS {key}"]
    columns += [f"CASE WHEN s.mark THEN s.{c} ELSE t.{c} END AS {c}" for c in _split(updated)]
    if stamped:
        columns += [
            "CASE WHEN t.mark THEN t.dt_inclusao ELSE s.first_inclusao END AS dt_inclusao",
            f"CASE WHEN s.mark AND (t.mark OR s.n > 1) THEN {run} WHEN s.mark THEN s.dt_atualizacao "
            "ELSE t.dt_atualizacao END AS dt_atualizacao",
        ]
    plain = ", ".join(_insert_columns(name))
    tgt_id = f"{surrogate}, " if surrogate else ""
    ctes[f"out_{name}"] = f"""
        SELECT {ids}{', '.join(columns)},
               CASE WHEN s.mark AND t.mark THEN 'update' WHEN s.mark THEN 'insert' ELSE 'keep' END AS act
        FROM (SELECT *, true AS mark FROM fold_{name}) s
        FULL OUTER JOIN (SELECT *, true AS mark FROM tgt_{name} WHERE {key} IS NOT NULL) t ON s.{key} = t.{key}
        {id_join}
        UNION ALL SELECT {tgt_id}{plain}, 'keep' FROM tgt_{name} WHERE {key} IS NULL
        UNION ALL SELECT {null_id}{plain}, 'insert' FROM res_{name} WHERE {key} IS NULL"""
    return ctes


def _with(ctes: dict[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes.items()) + "\n" + final


def load(name: str) -> str:
    return _with({**_input_ctes(name), **_merge_ctes(name)}, f"SELECT * EXCLUDE (act) FROM out_{name}")


def extract(name: str) -> str:
    return _with(_input_ctes(name), f"SELECT * FROM ext_{name}")


def resolved(name: str) -> str:
    return _with(_input_ctes(name), f"SELECT * FROM res_{name}")


def _loaded(name: str, *others: str, select: str) -> str:
    """A query over the loaded table of `name` and of further entities."""
    ctes = {}
    for n in (name, *others):
        ctes.update(_input_ctes(n))
    for n in (name, *others):
        ctes.update(_merge_ctes(n))
    return _with(ctes, select)


def upsert_actions() -> str:
    return _with({**_input_ctes("chamado"), **_merge_ctes("chamado")},
                 "SELECT nr_chamado, act AS acao FROM out_chamado")


def upsert_audit() -> str:
    return _with({**_input_ctes("solicitante"), **_merge_ctes("solicitante")},
                 f"SELECT cd_solicitante, id_solicitante, {AUDIT}, act AS acao FROM out_solicitante")


def upsert_surrogate_ids() -> str:
    return _with({**_input_ctes("solicitante"), **_merge_ctes("solicitante")},
                 "SELECT cd_solicitante, new_id AS id_solicitante FROM new_solicitante")


def upsert_duplicate_keys() -> str:
    return _with({**_input_ctes("chamado_sla"), **_merge_ctes("chamado_sla")}, """
        SELECT cd_registro_origem, id_chamado, id_sla, fl_breach, qt_tempo_restante_minutos,
               qt_tempo_decorrido_minutos, qt_meta_minutos, dt_referencia, first_inclusao AS dt_inclusao,
               CAST(n AS BIGINT) AS qt_linhas FROM fold_chamado_sla""")


def upsert_null_keys() -> str:
    return _with({**_input_ctes("chamado_status_historico"), **_merge_ctes("chamado_status_historico")}, """
        SELECT id_chamado, ds_status_chamado, dt_inicio_status, qt_tempo_status_minutos, dt_inclusao,
               dt_atualizacao, act AS acao
        FROM out_chamado_status_historico WHERE cd_registro_origem IS NULL""")


def upsert_null_keys_with_ids() -> str:
    """Ids after the highest of the target: first the new keys, then the rows without one, copies by their JSON form."""
    return f"""
        WITH tgt AS ({duckdb_sql(TARGET, "solicitante")}),
             res AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_name END AS cd_solicitante, c_mktsegment AS nm_solicitante FROM customer),
             fold AS (SELECT cd_solicitante, max(nm_solicitante) AS nm_solicitante FROM res
                      WHERE cd_solicitante IS NOT NULL GROUP BY 1),
             fresh AS (SELECT f.* FROM fold f WHERE NOT EXISTS (FROM tgt t WHERE t.cd_solicitante = f.cd_solicitante)),
             top AS (SELECT coalesce(max(id_solicitante), 0) AS id FROM tgt),
             given AS (SELECT (SELECT id FROM top) + row_number() OVER (ORDER BY substr(md5(cd_solicitante), 1, 3), cd_solicitante)
                              AS id_solicitante, * FROM fresh),
             unkeyed AS (SELECT (SELECT id FROM top) + (SELECT count(*) FROM fresh) + row_number() OVER (
                                ORDER BY substr(md5('{{"nm_solicitante":"' || nm_solicitante || '"}}'), 1, 3), nm_solicitante)
                                AS id_solicitante, * FROM res WHERE cd_solicitante IS NULL)
        SELECT t.id_solicitante, t.cd_solicitante, CASE WHEN f.cd_solicitante IS NULL THEN t.nm_solicitante ELSE f.nm_solicitante END
               AS nm_solicitante, CASE WHEN f.cd_solicitante IS NULL THEN 'keep' ELSE 'update' END AS acao
        FROM tgt t LEFT JOIN fold f ON t.cd_solicitante = f.cd_solicitante
        UNION ALL SELECT id_solicitante, cd_solicitante, nm_solicitante, 'insert' FROM given
        UNION ALL SELECT id_solicitante, cd_solicitante, nm_solicitante, 'insert' FROM unkeyed"""


def upsert_two_systems() -> str:
    """Key and system together tell scores apart, in the resolved rows and in the target."""
    name = "csat_avaliacao"
    by = "cd_registro_origem, nm_sistema_origem"
    attributes = ["id_chamado", "id_analista", "nr_score", "ds_comentario", "dt_avaliacao"]
    picked = ", ".join(f"CASE WHEN s.n IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in attributes)
    return _with({
        **_input_ctes(name),
        "both_systems": f"""SELECT * FROM res_{name} UNION ALL BY NAME
                            SELECT * REPLACE ('OLD' AS nm_sistema_origem, nr_score + 10 AS nr_score) FROM res_{name}""",
        "folded": f"""SELECT *, count(*) OVER (PARTITION BY {by}) AS n, min(dt_inclusao) OVER (PARTITION BY {by}) AS since
                      FROM both_systems
                      QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY dt_atualizacao DESC, dt_inclusao DESC) = 1""",
    }, f"""SELECT {picked}, coalesce(t.dt_inclusao, s.since) AS dt_inclusao,
                  CASE WHEN s.n > 1 OR s.n IS NOT NULL AND t.dt_inclusao IS NOT NULL THEN {RUN}
                       ELSE coalesce(s.dt_atualizacao, t.dt_atualizacao) END AS dt_atualizacao,
                  coalesce(s.nm_sistema_origem, t.nm_sistema_origem) AS nm_sistema_origem,
                  coalesce(s.cd_registro_origem, t.cd_registro_origem) AS cd_registro_origem,
                  CASE WHEN s.n IS NULL THEN 'keep' WHEN t.dt_inclusao IS NULL THEN 'insert' ELSE 'update' END AS acao
           FROM folded s FULL OUTER JOIN tgt_{name} t USING ({by})""")


def _rerun(name: str) -> str:
    """The second run stamps every row that stands in the source and changes nothing else."""
    return _with({**_input_ctes(name), **_merge_ctes(name)}, f"""
        SELECT * EXCLUDE (act) REPLACE (CASE WHEN act = 'keep' THEN dt_atualizacao ELSE {SECOND_RUN} END
               AS dt_atualizacao) FROM out_{name}""")


def upsert_rerun() -> str:
    return _rerun("solicitante")


def bucketed_rerun() -> str:
    return _rerun("chamado")


def resolve_rejects() -> str:
    return _with(_input_ctes("chamado"), """
        SELECT * FROM (
          SELECT t.nr_chamado, t.id_reporter, t.id_cliente_organizacao, concat_ws(',',
            CASE WHEN so.id_solicitante IS NULL THEN 'id_reporter:source'
                 WHEN s2.id_solicitante IS NULL THEN 'id_reporter:target' END,
            CASE WHEN org.id_cliente_organizacao IS NULL THEN 'id_cliente_organizacao:source'
                 WHEN o2.id_cliente_organizacao IS NULL THEN 'id_cliente_organizacao:target' END) AS reason
          FROM src_chamado t
          LEFT JOIN src_solicitante so ON t.id_reporter = so.id_solicitante
          LEFT JOIN tgt_solicitante s2 ON s2.cd_solicitante = so.cd_solicitante
          LEFT JOIN src_cliente_organizacao org ON t.id_cliente_organizacao = org.id_cliente_organizacao
          LEFT JOIN tgt_cliente_organizacao o2 ON o2.cd_cliente_organizacao = org.cd_cliente_organizacao
        ) WHERE reason <> ''""")


def resolve_repair() -> str:
    return _with({**_input_ctes("analista"), **_input_ctes("fila"), **_merge_ctes("fila")}, """
        SELECT x.cd_analista, before.id_fila AS id_fila_antes, later.id_fila AS id_fila_depois
        FROM ext_analista x
        LEFT JOIN tgt_fila before ON before.cd_fila = x.cd_fila_atual
        LEFT JOIN out_fila later ON later.cd_fila = x.cd_fila_atual""")


REOPENED = "CASE WHEN l_linenumber = 7 THEN 'REOPENED' WHEN l_linenumber = 6 THEN NULL"


def check_status_domain() -> str:
    return """
        SELECT CASE WHEN l_suppkey = 9 THEN NULL ELSE l_orderkey || '-' || l_linenumber END AS cd_registro_origem,
               l_orderkey AS id_chamado, 'REOPENED' AS ds_status_chamado
        FROM lineitem WHERE l_linenumber = 7"""


def check_lookup_unique() -> str:
    """Line numbers as a natural key: several line items share one."""
    return """
        SELECT l_orderkey || '-' || l_linenumber AS cd_sla, count(*) AS n
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


def open_tickets() -> str:
    return _with({**_input_ctes("chamado"), **_merge_ctes("chamado")}, """
        SELECT f.cd_fila, t.ds_prioridade, count(*) AS qt_chamados
        FROM out_chamado t LEFT JOIN tgt_fila f ON f.id_fila = t.id_fila_atual
        WHERE t.ds_status_chamado IN ('OPEN', 'IN_PROGRESS', 'PENDING') GROUP BY f.cd_fila, t.ds_prioridade""")


def closed_tickets() -> str:
    return _with({**_input_ctes("chamado"), **_merge_ctes("chamado")}, """
        SELECT CAST(date_trunc('month', dt_resolucao) AS TIMESTAMP) AS dt_mes, count(*) AS qt_chamados,
               round(avg(date_diff('second', dt_criacao, dt_resolucao) / 60.0), 6) AS qt_media_minutos
        FROM out_chamado WHERE ds_status_chamado IN ('RESOLVED', 'CLOSED') AND dt_resolucao IS NOT NULL
        GROUP BY 1""")


def ticket_overview() -> str:
    return _with({**_input_ctes("chamado"), **_merge_ctes("chamado")}, """
        SELECT ds_status_chamado, ds_prioridade,
               CAST(grouping_id(ds_status_chamado, ds_prioridade) AS BIGINT) AS nr_nivel, count(*) AS qt_chamados
        FROM out_chamado GROUP BY CUBE (ds_status_chamado, ds_prioridade)""")


def sla_breach() -> str:
    return _with({**_input_ctes("chamado_sla"), **_merge_ctes("chamado_sla")}, """
        SELECT s.cd_sla, s.nm_sla, count(*) AS qt_registros,
               CAST(count(*) FILTER (WHERE k.fl_breach) AS BIGINT) AS qt_breach,
               round(avg(CASE WHEN k.fl_breach THEN 1 WHEN NOT k.fl_breach THEN 0 END), 6) AS pc_breach
        FROM out_chamado_sla k LEFT JOIN tgt_sla s ON s.id_sla = k.id_sla GROUP BY k.id_sla, s.cd_sla, s.nm_sla""")


def csat_by_analyst() -> str:
    return _with({**_input_ctes("csat_avaliacao"), **_merge_ctes("csat_avaliacao")}, """
        SELECT a.cd_analista, count(r.nr_score) AS qt_respostas, round(avg(r.nr_score), 6) AS nr_media
        FROM out_csat_avaliacao r LEFT JOIN tgt_analista a ON a.id_analista = r.id_analista
        GROUP BY r.id_analista, a.cd_analista""")


def time_in_status() -> str:
    return _with({**_input_ctes("chamado_status_historico"), **_merge_ctes("chamado_status_historico")}, """
        SELECT ds_status_chamado, count(*) AS qt_registros,
               CAST(sum(qt_tempo_status_minutos) AS BIGINT) AS qt_total_minutos
        FROM out_chamado_status_historico GROUP BY ds_status_chamado""")


def history_as_of() -> str:
    """Snapshots before and after the load; as of a day between the second and a third."""
    return _with({**_input_ctes("solicitante"), **_merge_ctes("solicitante")},
                 "SELECT * EXCLUDE (act), DATE '2024-02-01' AS run_date FROM out_solicitante")


def history_intervals() -> str:
    """Snapshots before, after and before the load again; equal rows of neighbouring days form one interval."""
    columns = ", ".join(_target_columns("solicitante"))
    row = f"PARTITION BY {columns}, n_copies ORDER BY day"
    ctes = {
        **_input_ctes("solicitante"), **_merge_ctes("solicitante"),
        "snapshots": " UNION ALL ".join(f"SELECT DATE '{day}' AS day, {columns} FROM {table}_solicitante" for day, table in (
            ("2024-01-31", "tgt"), ("2024-02-01", "out"), ("2024-02-05", "tgt"))),
        "days": "SELECT day, lag(day) OVER (ORDER BY day) AS previous, lead(day) OVER (ORDER BY day) AS later FROM (SELECT DISTINCT day FROM snapshots)",
        "counted": "SELECT *, count(*) AS n_copies FROM snapshots GROUP BY ALL",
        "began": f"SELECT *, CASE WHEN lag(day) OVER ({row}) = previous THEN 0 ELSE 1 END AS fresh FROM counted JOIN days USING (day)",
        "numbered": f"SELECT *, sum(fresh) OVER ({row}) AS stretch FROM began",
    }
    return _with(ctes, f"""
        SELECT {columns}, n_copies, min(day) AS valid_from, nullif(max(coalesce(later, DATE '9999-12-31')), DATE '9999-12-31') AS valid_to
        FROM numbered GROUP BY {columns}, n_copies, stretch""")


def stream_two_sources() -> str:
    return _with({**_input_ctes("solicitante"), **_merge_ctes("solicitante")},
                 "SELECT * EXCLUDE (act, id_solicitante) FROM out_solicitante")


def run_report() -> str:
    """Loads chained in dependency order: every child sees its parents as just loaded."""
    ctes: dict[str, str] = {}
    counts = []
    for name in ("csat", "sla", "categoria", "cliente_organizacao", "fila", "solicitante", "analista", "chamado",
                 "chamado_status_historico", "csat_avaliacao", "chamado_sla"):
        ctes[f"src_{name}"] = duckdb_sql(SOURCE, name)
        ctes[f"tgt_{name}"] = duckdb_sql(TARGET, name)
        if name in EXTRACT:
            ctes[f"ext_{name}"] = EXTRACT[name]
            ctes[f"res_{name}"] = RESOLVE[name].replace("JOIN tgt_", "JOIN out_")
        else:
            ctes[f"res_{name}"] = f"SELECT {', '.join(_insert_columns(name))} FROM src_{name}"
        ctes.update(_merge_ctes(name))
        counts.append(f"""
            SELECT '{name}' AS entity, 'loaded' AS status,
                   (SELECT count(*) FROM src_{name}) AS rows_read,
                   (SELECT count(*) FROM src_{name}) - (SELECT count(*) FROM res_{name}) AS rejected,
                   CAST(0 AS BIGINT) AS quarantined,
                   count(*) FILTER (WHERE act = 'insert') AS inserted,
                   count(*) FILTER (WHERE act = 'update') AS updated,
                   count(*) FILTER (WHERE act = 'keep') AS kept FROM out_{name}""")
    return _with(ctes, " UNION ALL ".join(counts))
