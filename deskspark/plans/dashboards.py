"""Dashboard numbers kept up to date beside the published tables.

Each dashboard has a tally, a published table of its own: whole numbers by group, and the version of
the fact table that they were counted on. A refresh compares that version with the current one. Of a
bucketed table only the buckets that lie in another folder than before are read: what they held is
taken from the tally, what they hold now is added. Reports read the tally and the names, never the
facts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskspark.operators import metrics
from deskspark.plans.entities import ENTITIES
from deskspark.plans.spec import EntitySpec
from deskspark.sources.store import TableStore

ROWS = "qt_linhas"


@dataclass(frozen=True)
class Dashboard:
    """`tally` has the columns `groups`, ROWS and further whole numbers that add up; `read` takes it and the tables `names`."""

    fact: str
    groups: tuple[str, ...]
    tally: Callable[[DataFrame], DataFrame]
    read: Callable[..., DataFrame]
    names: tuple[str, ...] = ()


DASHBOARDS: dict[str, Dashboard] = {
    "open_tickets": Dashboard(
        "chamado", ("id_fila_atual", "ds_prioridade"), metrics.tally_open_tickets, metrics.read_open_tickets, ("fila",)),
    "closed_tickets": Dashboard("chamado", ("dt_mes",), metrics.tally_closed_tickets, metrics.read_closed_tickets),
    "ticket_overview": Dashboard(
        "chamado", ("ds_status_chamado", "ds_prioridade"), metrics.tally_ticket_overview, metrics.read_ticket_overview),
    "sla_breach": Dashboard("chamado_sla", ("id_sla",), metrics.tally_sla_breach, metrics.read_sla_breach, ("sla",)),
    "csat_by_analyst": Dashboard(
        "csat_avaliacao", ("id_analista",), metrics.tally_csat_by_analyst, metrics.read_csat_by_analyst, ("analista",)),
    "time_in_status": Dashboard(
        "chamado_status_historico", ("ds_status_chamado",), metrics.tally_time_in_status, metrics.read_time_in_status),
}


class Dashboards:
    def __init__(self, spark: SparkSession, store: TableStore, specs: Mapping[str, EntitySpec] = ENTITIES,
                 boards: Mapping[str, Dashboard] = DASHBOARDS):
        self.spark, self.store, self.specs, self.boards = spark, store, specs, boards

    def refresh(self, name: str) -> list[int] | None:
        """Bring a tally to the current version of its facts; returns the buckets read, None for the whole table.

        The facts are read whole the first time, where they are not bucketed or are bucketed in another
        way than before, where all buckets changed, and where the version counted last was removed
        meanwhile. If two refreshes race, one raises `PublishConflict` and changes nothing.
        """
        board, tally_name = self.boards[name], f"{name}_tally"
        schema = self.specs[board.fact].target_schema
        before, now = self.store.pointer(tally_name), self.store.pointer(board.fact)
        counted = before["counted"] if before else None
        layout = {k: now[k] for k in ("version", "buckets", "key", "held_in") if k in now} if now else {}
        if before and counted == layout:
            return []
        changed = self.store.changed_buckets(board.fact, counted, now) if counted and now else None
        if changed is None:
            tally = board.tally(self.store.current(board.fact, schema))
        else:
            old, new = (board.tally(self.store.read(board.fact, entry, schema, changed)) for entry in (counted, now))
            tally = self._added_up(board, self._tally(name), old, new)
        version = self.store.write(tally_name, tally)
        self.store.publish(tally_name, version, expected=before["version"] if before else None, counted=layout)
        return changed

    def refresh_all(self) -> dict[str, list[int] | None]:
        return {name: self.refresh(name) for name in self.boards}

    def report(self, name: str) -> DataFrame:
        """The dashboard as of its last refresh, with the names as they are now."""
        board = self.boards[name]
        return board.read(self._tally(name), *(self.store.current(n, self.specs[n].target_schema) for n in board.names))

    def _tally(self, name: str) -> DataFrame:
        board = self.boards[name]
        schema = board.tally(self.spark.createDataFrame([], self.specs[board.fact].target_schema)).schema
        return self.store.current(f"{name}_tally", schema)

    @staticmethod
    def _added_up(board: Dashboard, tally: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
        """tally - old + new, without the groups that have no rows left."""
        measures = [c for c in tally.columns if c not in board.groups]
        taken = old.select(*board.groups, *((-F.col(c)).alias(c) for c in measures))
        parts = tally.unionByName(taken).unionByName(new)
        return parts.groupBy(*board.groups).agg(*(F.sum(c).alias(c) for c in measures)).filter(F.col(ROWS) != 0)
