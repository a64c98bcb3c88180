"""Source and target tables kept in a SQL Server database, through Spark's JDBC format."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from deskspark.plans.entities import ENTITIES
from deskspark.plans.spec import EntitySpec, column_type

# Names of the environment variables, and connection settings.
SETTINGS = ("SQL_SERVER", "SQL_DATABASE", "SQL_USER", "SQL_PASSWORD")
SOURCE, TARGET = "SOURCE", "TARGET"
CONNECT_TIMEOUT_SECONDS = 30
DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
FETCH_ROWS = 10_000
BATCH_ROWS = 10_000


def connection_options(side: str, environ: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options for one side from `SQL_SERVER_<side>` and its three companions."""
    environ = os.environ if environ is None else environ
    missing = [f"{s}_{side}" for s in SETTINGS if not environ.get(f"{s}_{side}")]
    if missing:
        raise KeyError("not set: " + ", ".join(missing))
    server, database, user, password = (environ[f"{s}_{side}"] for s in SETTINGS)
    host, _, port = server.removeprefix("tcp:").partition(",")
    address = f"{host}:{port.strip()}" if port else host
    return {
        "url": (
            f"jdbc:sqlserver://{address};databaseName={database};encrypt=true;"
            f"trustServerCertificate=false;loginTimeout={CONNECT_TIMEOUT_SECONDS}"
        ),
        "driver": DRIVER,
        "user": user,
        "password": password,
    }


def slice_column(spec: EntitySpec) -> str:
    """What a table is cut by: its id, else its key. Neither changes while the table is read, as stamps do."""
    return spec.surrogate or spec.key


def bounds_query(spec: EntitySpec, schema: str, slices: int) -> str:
    """A query for the values at which slices begin, in the database's own order.

    Ids are cut evenly between the smallest and the largest, both of which an index has at hand; texts
    at quantiles.
    """
    column, table = slice_column(spec), f"{schema}.{spec.name}"
    if column_type(column) == T.LongType():
        return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"
    return (f"SELECT part, MIN({column}) AS low FROM (SELECT {column}, NTILE({slices}) OVER (ORDER BY {column}) AS part "
            f"FROM {table} WHERE {column} IS NOT NULL) AS parts GROUP BY part")


def even_bounds(low: int | None, high: int | None, slices: int) -> list[int]:
    """Where ids from `low` to `high` are cut into slices of equal width; none in an empty table."""
    if low is None:
        return []
    width = high - low + 1
    return sorted({low + width * i // slices for i in range(1, slices)} - {low})


def bounds_of(found: Sequence[tuple], column: str, slices: int) -> list[int | str]:
    """The bounds that the rows of a bounds query stand for; texts stay in the order the database gave them."""
    if column_type(column) == T.LongType():
        return even_bounds(*found[0], slices)
    return [low for _, low in sorted(found, key=lambda r: r[0])][1:]


def literal(value: int | str) -> str:
    return str(value) if isinstance(value, int) else "N'" + value.replace("'", "''") + "'"


def range_predicates(column: str, bounds: Sequence[int | str]) -> list[str]:
    """Disjoint conditions that together cover all rows, one per read task, from ascending bounds.

    The outer ranges are open, so rows added after the bounds were looked up are read as well.
    """
    cuts = [literal(b) for b in bounds]
    if not cuts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]}", *inner, f"{column} >= {cuts[-1]}", f"{column} IS NULL"]


def read_table(spark: SparkSession, spec: EntitySpec, options: Mapping[str, str], schema: str,
               slices: int = 64) -> DataFrame:
    """A whole table, each row read once, by a task for each of up to `slices` ranges of its id or key and
    one for rows without; only the declared columns. At most a bound for each slice comes to the driver."""
    properties = {k: v for k, v in options.items() if k != "url"}
    properties["fetchsize"] = str(FETCH_ROWS)
    properties["preferTimestampNTZ"] = "true"
    found = spark.read.format("jdbc").options(**options).option("query", bounds_query(spec, schema, slices)).load().collect()
    column = slice_column(spec)
    bounds = bounds_of([tuple(r) for r in found], column, slices)
    table = spark.read.jdbc(options["url"], f"{schema}.{spec.name}", predicates=range_predicates(column, bounds), properties=properties)
    return table.select(*(table[f.name].cast(f.dataType).alias(f.name) for f in spec.source_schema
                          if f.name in table.columns))


@dataclass(frozen=True)
class Export:
    """The statements that bring a finished load into its table, all or nothing.

    Spark's tasks fill a side table, which may take long and be begun again; then one transaction takes
    its rows over. Until its end readers of the table see the old rows.
    """

    side: str
    before: tuple[str, ...]
    transaction: tuple[str, ...]
    after: tuple[str, ...]


def export_of(spec: EntitySpec, schema: str, token: str) -> Export:
    """Rows are matched by the surrogate id, or by the key (and its scope) where there is none. No row is deleted but
    those without a key, which nothing matches and which the load carries on as a whole."""
    table, side, by = f"{schema}.{spec.name}", f"{schema}.{spec.name}__{token}", slice_column(spec)
    names = spec.target_columns
    columns = ", ".join(names)
    empty = f"SELECT {columns} FROM {table} WHERE 1 = 0"
    updates = ", ".join(f"{c} = s.{c}" for c in names if c != by)
    identity = f"IF OBJECTPROPERTY(OBJECT_ID('{table}'), 'TableHasIdentity') = 1 SET IDENTITY_INSERT {table}"
    unkeyed = () if spec.surrogate else (f"DELETE FROM {table} WHERE {by} IS NULL",)
    scope = "" if spec.surrogate else "".join(
        f" AND (t.{c} = s.{c} OR t.{c} IS NULL AND s.{c} IS NULL)" for c in spec.scope)
    merge = (f"MERGE INTO {table} AS t USING {side} AS s ON t.{by} = s.{by}{scope} WHEN MATCHED THEN UPDATE SET {updates} "
             f"WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({', '.join(f's.{c}' for c in names)});")
    return Export(
        side,
        # A union loses the identity property, so that the side table takes ids as they are.
        (f"DROP TABLE IF EXISTS {side}", f"SELECT {columns} INTO {side} FROM ({empty} UNION ALL {empty}) AS none"),
        (*((f"{identity} ON",) if spec.surrogate else ()), *unkeyed, merge, *((f"{identity} OFF",) if spec.surrogate else ())),
        (f"DROP TABLE IF EXISTS {side}",),
    )


def run_statements(spark: SparkSession, options: Mapping[str, str], statements: Sequence[str], whole: bool) -> None:
    """Run statements from the driver, as one transaction if `whole`. They carry names, never rows."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName(options["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], options["user"], options["password"])
    try:
        connection.setAutoCommit(not whole)
        for statement in statements:
            run = connection.createStatement()
            run.execute(statement)
            run.close()
        if whole:
            connection.commit()
    except Exception:
        if whole:
            connection.rollback()
        raise
    finally:
        connection.close()


def write_table(df: DataFrame, spec: EntitySpec, options: Mapping[str, str], schema: str, connections: int = 16,
                run=run_statements) -> None:
    """Bring a finished load into its table: all of it, or nothing if a task, the driver or the database fails.

    A side table that a lost driver leaves behind is nobody's and can be dropped.
    """
    export = export_of(spec, schema, uuid.uuid4().hex[:12])
    run(df.sparkSession, options, export.before, False)
    try:
        (
            df.select(*spec.target_columns).repartition(connections).write.format("jdbc").options(**options)
            .option("dbtable", export.side).option("batchsize", BATCH_ROWS).mode("append").save()
        )
        run(df.sparkSession, options, export.transaction, True)
    finally:
        run(df.sparkSession, options, export.after, False)


class JdbcSource(Mapping):
    """name -> DataFrame over the tables of one database schema."""

    live = True

    def __init__(self, spark: SparkSession, schema: str, options: Mapping[str, str] | None = None,
                 slices: int = 64, specs: Mapping[str, EntitySpec] = ENTITIES):
        self.spark, self.schema, self.slices, self.specs = spark, schema, slices, specs
        self.options = dict(options or connection_options(SOURCE))

    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.specs[name], self.options, self.schema, self.slices)

    def __iter__(self) -> Iterator[str]:
        return iter(self.specs)

    def __len__(self) -> int:
        return len(self.specs)
