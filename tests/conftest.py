from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from deskspark.plans.entities import ENTITIES  # noqa: E402
from deskspark.session import build_session  # noqa: E402

RUN_TS = datetime(2024, 2, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "deskspark-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def frame(spark, schema, rows):
    """Rows given as dicts; columns left out are NULL."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def source_frame(spark, name, rows):
    return frame(spark, ENTITIES[name].source_schema, rows)


def records(df):
    return [r.asDict() for r in df.collect()]


def canon(rows, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in rows)


def audit(created="2023-06-01", changed="2023-12-31", system="SRC", record="R"):
    return {
        "dt_inclusao": datetime.fromisoformat(created), "dt_atualizacao": datetime.fromisoformat(changed),
        "nm_sistema_origem": system, "cd_registro_origem": record,
    }


OLD = audit("2022-01-01", "2022-06-01", "OLD", "OLD")
