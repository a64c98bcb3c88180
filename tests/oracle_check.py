"""Compare every registered query with its SQL. `python tests/oracle_check.py [sf dir] [names…]`"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from deskspark.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def compare(spark, con, sf: str, name: str) -> tuple[bool | None, str]:
    """Whether rows and types are the same; None for a query without SQL, which is only counted."""
    start = time.time()
    df = entry.queries()[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    seconds = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, f"{len(got[1])} rows, no SQL, {seconds:.1f}s"
    types = {r[0]: SPARK_TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if types != {f.name: f.dataType.simpleString() for f in df.schema}:
        return False, f"types {sorted(types.items())} vs {sorted((f.name, f.dataType.simpleString()) for f in df.schema)}"
    cursor = con.execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got == want:
        return True, f"{len(got[1])} rows, {seconds:.1f}s"
    detail = f"{len(got[1])} != {len(want[1])} rows; columns {got[0]} vs {want[0]}"
    extra = sorted(set(got[1]) - set(want[1]))[:2], sorted(set(want[1]) - set(got[1]))[:2]
    return False, f"{detail}\n  only spark {extra[0]}\n  only sql {extra[1]}"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(master="local[8]", spark__sql__shuffle__partitions="8")
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for query in sys.argv[2:] or entry.queries():
        try:
            same, text = compare(session, connection, sf_dir, query)
        except Exception as error:
            same, text = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += same is False
        print({True: "ok  ", False: "FAIL", None: "none"}[same], query, text, flush=True)
    sys.exit(1 if failed else 0)
