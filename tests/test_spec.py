from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from deskspark.functions.clock import stamp, utc_now
from deskspark.functions.keys import match_key
from deskspark.plans.entities import ENTITIES
from deskspark.plans.spec import column_type
from deskspark.sources import jdbc

ENV = {f"{s}_SOURCE": v for s, v in zip(jdbc.SETTINGS, ("db.example,1444", "desk", "reader", "secret"))}


def test_column_counts():
    inserted = {n: len(s.insert_columns) for n, s in ENTITIES.items()}
    assert inserted == {
        "csat": 3, "sla": 9, "categoria": 8, "cliente_organizacao": 8, "fila": 8, "solicitante": 10, "analista": 10,
        "chamado": 18, "chamado_status_historico": 11, "csat_avaliacao": 9, "chamado_sla": 11,
    }
    assert all(len(s.extract_columns) == len(s.insert_columns) for s in ENTITIES.values())


def test_updates_leave_key_and_creation_alone():
    for spec in ENTITIES.values():
        assert not {spec.key, "dt_inclusao", spec.surrogate} & set(spec.update_columns)
    assert ENTITIES["csat"].update_columns == ("Column1", "Column2")


def test_types():
    assert column_type("nr_cnpj").simpleString() == "string"
    assert column_type("nr_score").simpleString() == "int"
    assert column_type("dt_criacao").simpleString() == "timestamp_ntz"


def test_stamp_is_utc():
    local = datetime(2024, 1, 1, 3, tzinfo=timezone(timedelta(hours=-3)))
    assert stamp(local) == "TIMESTAMP_NTZ '2024-01-01 06:00:00.000000'"
    assert utc_now().tzinfo is None


def test_unknown_comparison():
    with pytest.raises(ValueError):
        match_key("k", "soundex")


def test_connection_options():
    options = jdbc.connection_options(jdbc.SOURCE, ENV)
    assert options["url"].startswith("jdbc:sqlserver://db.example:1444;databaseName=desk;encrypt=true;")
    assert "loginTimeout=30" in options["url"] and options["user"] == "reader"
    with pytest.raises(KeyError, match="SQL_SERVER_TARGET"):
        jdbc.connection_options(jdbc.TARGET, ENV)
