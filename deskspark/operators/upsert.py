"""Fold duplicate keys, then merge rows into a target.

The outcome equals applying the rows one at a time in `spec.order_columns` order: a row whose
key is in the target overwrites the listed columns and is stamped with the run time; a row
whose key is not there is inserted with its own stamps. Target rows without a partner stay.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from deskspark.functions.clock import stamp
from deskspark.functions.keys import BINARY
from deskspark.operators.surrogate import (
    Ranges, bucket_starts, copy_ids, key_ids, place_copies, place_copies_by_ranges, place_keys, place_keys_by_ranges,
)
from deskspark.plans.spec import EntitySpec

ACTION = "_action"
COUNT = "_n"
BOOKKEEPING = (ACTION, COUNT)


def fold(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per non-NULL key: the last row's values, the first row's `dt_inclusao`, the row count.

    The aggregates combine before the shuffle, so a key that holds a large share of all rows
    sends one row per input task. Columns that are equal within a group are shuffled in its key only.
    """
    order = spec.order_columns
    first = (["dt_inclusao"] if spec.stamped else []) + ([spec.key] if spec.match != BINARY else [])
    same = {c: f"_k.{c}" for c in spec.scope}
    if spec.match == BINARY:
        same[spec.key] = f"_k.{spec.key}" if spec.scope else "_k"
    last = [c for c in order if c not in same] or [spec.key]
    aggregates = [f"max(struct({', '.join(last)})) AS _last", f"count(1) AS {COUNT}"]
    if first:
        seq = order[: order.index(spec.key)] if spec.stamped else ()
        aggregates.append(f"min(struct({', '.join(dict.fromkeys((*seq, *first)))})) AS _first")
    columns = [f"{same.get(c) or ('_first.' if c in first else '_last.') + c} AS {c}" for c in spec.insert_columns]
    return rows.sparkSession.sql(
        f"""SELECT _k, {', '.join(columns)}, {COUNT}
            FROM (SELECT {spec.merge_key()} AS _k, {', '.join(aggregates)}
                  FROM {{rows}} WHERE {spec.key} IS NOT NULL GROUP BY 1)""",
        rows=rows,
    )


def new_keys(rows: DataFrame, target: DataFrame, spec: EntitySpec) -> DataFrame:
    """(_k): the distinct keys of `rows` that the target lacks. Only key columns are read."""
    key, held = spec.merge_key("r"), spec.merge_key("t")
    return rows.sparkSession.sql(
        f"""SELECT d._k FROM (SELECT DISTINCT {key} AS _k FROM {{rows}} r WHERE r.{spec.key} IS NOT NULL) d
            LEFT ANTI JOIN {{target}} t ON d._k = {held}""",
        rows=rows, target=target,
    )


def lacks_keys(rows: DataFrame, spec: EntitySpec) -> bool:
    """Whether any row has no key. Reads one column, and of a Parquet file only parts with NULLs."""
    return not rows.filter(f"{spec.key} IS NULL").isEmpty()


def merge(target: DataFrame, rows: DataFrame, spec: EntitySpec, run_ts: datetime,
          survivors: DataFrame | None = None, null_keys: bool = True, target_null_keys: bool = True,
          top: int | None = None, ranges: Ranges | None = None) -> DataFrame:
    """The whole target after the run, with `_action` and the count of rows behind each row.

    `rows` are resolved rows (`spec.insert_columns`). To give ids, their keys are read once more;
    `survivors` may supply a cheaper table with the same keys. Where the caller has seen that no
    row lacks its key, `null_keys=False` (for the rows) and `target_null_keys=False` leave that
    part of the plan out. `top` is the highest id given so far where `target` is only the part of a
    table that can hold the rows' keys. `ranges` numbers by that many ranges instead of md5 buckets, which
    writes the new keys at once; the ids are the same.
    """
    folded = fold(rows, spec)
    fresh = rows.filter(f"{spec.key} IS NULL").select(*spec.insert_columns)
    tables = {"target": target}
    new_id = id_join = ""
    if spec.surrogate:
        keys = new_keys(rows if survivors is None else survivors, target, spec)
        keyed = place_keys_by_ranges(keys, "_k", ranges) if ranges else place_keys(keys, "_k")
        placed = [keyed]
        if null_keys:
            placed.append(place_copies_by_ranges(fresh, ranges) if ranges else place_copies(fresh))
        starts = bucket_starts(target, spec.surrogate, *placed, top=top)
        tables["ids"] = key_ids(keyed, starts, "_k", spec.surrogate)
        if null_keys:
            fresh = copy_ids(placed[1], starts, list(spec.insert_columns), spec.surrogate)
        new_id = f", i.{spec.surrogate}"
        id_join = "LEFT JOIN {ids} i ON f._k = i._k"
    tables["folded"] = folded
    columns = ", ".join(spec.target_columns)
    unkeyed = ""
    if target_null_keys:
        unkeyed += f" UNION ALL SELECT {columns}, 'keep', 0L FROM {{target}} WHERE {spec.key} IS NULL"
    if null_keys:
        tables["fresh"] = fresh
        unkeyed += f" UNION ALL SELECT {columns}, 'insert', 1L FROM {{fresh}}"
    return target.sparkSession.sql(
        f"""SELECT {', '.join(_merged_columns(spec, run_ts))},
                   CASE WHEN s._s AND t._t THEN 'update' WHEN s._s THEN 'insert' ELSE 'keep' END AS {ACTION},
                   coalesce(s.{COUNT}, 0L) AS {COUNT}
            FROM (SELECT *, {spec.merge_key()} AS _k, true AS _t FROM {{target}}
                  WHERE {spec.key} IS NOT NULL) t
            FULL OUTER JOIN (SELECT f.*, true AS _s{new_id} FROM {{folded}} f {id_join}) s ON t._k = s._k
            {unkeyed}""",
        **tables,
    )


def _merged_columns(spec: EntitySpec, run_ts: datetime) -> list[str]:
    """Marker columns, not key columns, tell the two sides of the outer join apart."""
    updated = set(spec.update_columns)
    columns = []
    for c in spec.target_columns:
        if c in updated:
            value = f"CASE WHEN s._s THEN s.{c} ELSE t.{c} END"
        elif c == "dt_atualizacao":
            value = (f"CASE WHEN s._s AND (t._t OR s.{COUNT} > 1) THEN {stamp(run_ts)} "
                     f"WHEN s._s THEN s.{c} ELSE t.{c} END")
        else:
            value = f"CASE WHEN t._t THEN t.{c} ELSE s.{c} END"
        columns.append(f"{value} AS {c}")
    return columns
