"""Foreign keys: source id -> natural key -> target id."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from deskspark.functions.keys import match_key
from deskspark.plans.entities import ENTITIES
from deskspark.plans.spec import EntitySpec, Lookup
from deskspark.session import broadcastable

Tables = Mapping[str, DataFrame]
Specs = Mapping[str, EntitySpec]


def _join(lookup_how: str, table: str, condition: str) -> str:
    return f"{lookup_how.upper()} JOIN {table} ON {condition}"


def _columns(names, prefix: str = "f") -> list[str]:
    return [f"{prefix}.{n}" for n in names]


def link(source_parent: DataFrame, target_parent: DataFrame, spec: EntitySpec, how: str = "inner") -> DataFrame:
    """(sid, tid): which target id stands for which source id."""
    source_key, target_key = (match_key(f"{side}.{spec.key}", spec.match) for side in "st")
    return source_parent.sparkSession.sql(
        f"SELECT s.{spec.surrogate} AS sid, t.{spec.surrogate} AS tid FROM {{source}} s "
        + _join(how, "{target} t", f"{source_key} = {target_key}"),
        source=source_parent, target=target_parent,
    )


def extract(rows: DataFrame, spec: EntitySpec, source: Tables, specs: Specs = ENTITIES) -> DataFrame:
    """Replace the source's foreign ids by natural keys; a missing required parent drops the row."""
    tables, joins, codes = {"rows": rows}, [], []
    for i, lk in enumerate(spec.lookups):
        parent = specs[lk.parent]
        tables[f"s{i}"] = source[lk.parent].select(parent.surrogate, parent.key)
        joins.append(_join(lk.how, f"{{s{i}}} s{i}", f"f.{lk.column} = s{i}.{parent.surrogate}"))
        codes.append(f"s{i}.{parent.key} AS {lk.code}")
    columns = _columns(spec.attributes) + codes + _columns(spec.audit)
    return rows.sparkSession.sql(f"SELECT {', '.join(columns)} FROM {{rows}} f {' '.join(joins)}", **tables)


def resolve_codes(extracted: DataFrame, spec: EntitySpec, target: Tables, specs: Specs = ENTITIES) -> DataFrame:
    """Replace natural keys by the target's ids, for rows that arrive already extracted."""
    tables, joins, ids = {"rows": extracted}, [], []
    for i, lk in enumerate(spec.lookups):
        parent = specs[lk.parent]
        tables[f"t{i}"] = target[lk.parent].select(parent.surrogate, parent.key)
        code, key = match_key(f"f.{lk.code}", parent.match), match_key(f"t{i}.{parent.key}", parent.match)
        joins.append(_join(lk.how, f"{{t{i}}} t{i}", f"{code} = {key}"))
        ids.append(f"t{i}.{parent.surrogate} AS {lk.column}")
    columns = _columns(spec.attributes) + ids + _columns(spec.audit)
    return extracted.sparkSession.sql(f"SELECT {', '.join(columns)} FROM {{rows}} f {' '.join(joins)}", **tables)


def resolve(rows: DataFrame, spec: EntitySpec, source: Tables, target: Tables, specs: Specs = ENTITIES,
            links: Tables | None = None) -> DataFrame:
    """Both steps at once.

    A parent whose two sides fit a broadcast is joined step by step, which shuffles nothing.
    For a larger parent the two narrow sides are joined to each other first, so that the wide
    rows are shuffled once for that parent instead of twice. `links` may hold such pairs
    written beforehand; they keep source ids without a partner, so that an optional lookup finds
    what two left joins find, also where a source id occurs twice. Both ways give the same rows.
    """
    tables, joins, ids = {"rows": rows}, [], []
    for i, lk in enumerate(spec.lookups):
        parent = specs[lk.parent]
        pair = links.get(lk.parent) if links else None
        if pair is None:
            s = source[lk.parent].select(parent.surrogate, parent.key)
            t = target[lk.parent].select(parent.surrogate, parent.key)
            if broadcastable(s) and broadcastable(t):
                tables[f"s{i}"], tables[f"t{i}"] = s, t
                code, key = (match_key(f"{side}{i}.{parent.key}", parent.match) for side in "st")
                joins.append(_join(lk.how, f"{{s{i}}} s{i}", f"f.{lk.column} = s{i}.{parent.surrogate}"))
                joins.append(_join(lk.how, f"{{t{i}}} t{i}", f"{code} = {key}"))
                ids.append(f"t{i}.{parent.surrogate} AS {lk.column}")
                continue
            pair = link(s, t, parent, "left")
        tables[f"p{i}"] = pair
        found = f" AND p{i}.tid IS NOT NULL" if lk.required else ""
        joins.append(_join(lk.how, f"{{p{i}}} p{i}", f"f.{lk.column} = p{i}.sid{found}"))
        ids.append(f"p{i}.tid AS {lk.column}")
    columns = _columns(spec.attributes) + ids + _columns(spec.audit)
    return rows.sparkSession.sql(f"SELECT {', '.join(columns)} FROM {{rows}} f {' '.join(joins)}", **tables)


def far_lookups(spec: EntitySpec, links: Tables) -> list[Lookup]:
    """The lookups whose pairs in `links` are too large to broadcast."""
    return [lk for lk in spec.lookups if lk.parent in links and not broadcastable(links[lk.parent])]


def resolve_in_turn(rows: DataFrame, spec: EntitySpec, source: Tables, target: Tables, specs: Specs, links: Tables,
                    deal: Callable[[str, DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of `resolve`, for large tables: parents whose pairs in `links` are no broadcast are joined one after the other.

    Before each of these joins `deal(label, table, column)` deals out the rows and the pairs by the id they meet on. The rows
    carry the source's ids of the parents still to come. Where a parent is required, rows without an id stay behind.
    """
    large = far_lookups(spec, links)
    near = tuple(lk for lk in spec.lookups if lk not in large)
    carried = (*spec.attributes, *(lk.column for lk in large))
    rows = resolve(rows, spec.with_options(attributes=carried, lookups=near), source, target, specs, links)
    for lk in large:
        pairs = links[lk.parent].filter("sid IS NOT NULL" + (" AND tid IS NOT NULL" if lk.required else ""))
        dealt = deal(spec.name, rows.filter(f"{lk.column} IS NOT NULL") if lk.required else rows, lk.column)
        columns = [f"p.tid AS {c}" if c == lk.column else f"f.{c}" for c in spec.insert_columns]
        rows = rows.sparkSession.sql(
            f"SELECT /*+ MERGE(p) */ {', '.join(columns)} FROM {{rows}} f " + _join(lk.how, "{pairs} p", f"f.{lk.column} = p.sid"),
            rows=dealt, pairs=deal(f"link_{lk.parent}", pairs, "sid"))
    return rows.select(*spec.insert_columns)


def survivors(rows: DataFrame, spec: EntitySpec, source: Tables, target: Tables, specs: Specs = ENTITIES,
              links: Tables | None = None) -> DataFrame:
    """The keys of the rows that `resolve` keeps. Optional parents drop nothing and are not joined."""
    required = tuple(lk for lk in spec.lookups if lk.required)
    return resolve(rows, spec.with_options(lookups=required), source, target, specs, links).select(*spec.key_columns)


def kept(rows: DataFrame, spec: EntitySpec, source: Tables, target: Tables, specs: Specs = ENTITIES) -> DataFrame:
    """The rows that `resolve` keeps, each once, also where a parent's source id occurs several times."""
    tables, joins = {"rows": rows}, []
    for i, lk in enumerate(k for k in spec.lookups if k.required):
        tables[f"p{i}"] = link(source[lk.parent], target[lk.parent], specs[lk.parent])
        joins.append(_join("left semi", f"{{p{i}}} p{i}", f"f.{lk.column} = p{i}.sid"))
    return rows.sparkSession.sql(f"SELECT * FROM {{rows}} f {' '.join(joins)}", **tables)


def repeated_ids(source_parent: DataFrame, spec: EntitySpec) -> DataFrame:
    """(id, n) for source ids held by more than one row; a row that refers to one is resolved several times."""
    return source_parent.sparkSession.sql(
        f"SELECT {spec.surrogate}, count(1) AS n FROM {{rows}} WHERE {spec.surrogate} IS NOT NULL GROUP BY 1 HAVING n > 1",
        rows=source_parent)


def rejects(rows: DataFrame, spec: EntitySpec, source: Tables, target: Tables, specs: Specs = ENTITIES) -> DataFrame:
    """The rows that `resolve` drops, each with the required parents it lacks and on which side."""
    tables, joins, reasons = {"rows": rows}, [], []
    for i, lk in enumerate(k for k in spec.lookups if k.required):
        tables[f"p{i}"] = link(source[lk.parent], target[lk.parent], specs[lk.parent], "left")
        joins.append(_join("left", f"{{p{i}}} p{i}", f"f.{lk.column} = p{i}.sid"))
        reasons.append(f"CASE WHEN p{i}.sid IS NULL THEN '{lk.column}:source' "
                       f"WHEN p{i}.tid IS NULL THEN '{lk.column}:target' END")
    columns = ", ".join(_columns(spec.insert_columns))
    return rows.sparkSession.sql(
        f"SELECT * FROM (SELECT {columns}, concat_ws(',', {', '.join(reasons) or 'NULL'}) AS reason "
        f"FROM {{rows}} f {' '.join(joins)}) WHERE reason <> ''", **tables,
    )


def unresolved(rows: DataFrame, spec: EntitySpec, source: Tables, target: Tables, specs: Specs = ENTITIES) -> DataFrame:
    """(key, parent, code), once each: the natural keys that rows refer to and the target lacks, of optional parents.

    The parents that the target lacks come first, as they are few; of the rows only key and foreign id are read.
    Rows without a key are left out, as nothing could find them again.
    """
    tables, parts = {"rows": rows}, []
    for i, lk in enumerate(k for k in spec.lookups if not k.required):
        parent = specs[lk.parent]
        tables[f"s{i}"] = source[lk.parent].select(parent.surrogate, parent.key)
        tables[f"t{i}"] = target[lk.parent].select(parent.surrogate, parent.key)
        source_key, target_key = (match_key(f"{side}.{parent.key}", parent.match) for side in "st")
        parts.append(
            f"SELECT f.{spec.key}, '{lk.parent}' AS parent, m.code FROM {{rows}} f JOIN "
            f"(SELECT s.{parent.surrogate} AS sid, s.{parent.key} AS code FROM {{s{i}}} s "
            f"LEFT ANTI JOIN {{t{i}}} t ON {source_key} = {target_key} WHERE s.{parent.key} IS NOT NULL) m "
            f"ON f.{lk.column} = m.sid WHERE f.{spec.key} IS NOT NULL")
    if not parts:
        parts.append(f"SELECT f.{spec.key}, '' AS parent, '' AS code FROM {{rows}} f WHERE false")
    return rows.sparkSession.sql(f"SELECT DISTINCT * FROM ({' UNION ALL '.join(parts)})", **tables)


def keys_found_again(waiting: DataFrame, spec: EntitySpec, target: Tables, specs: Specs = ENTITIES) -> DataFrame:
    """The keys in `waiting` (as `unresolved` gives it) some code of which the target has by now, once each."""
    tables, parts = {"waiting": waiting}, []
    for i, name in enumerate(sorted({lk.parent for lk in spec.lookups if not lk.required})):
        parent = specs[name]
        tables[f"t{i}"] = target[name].select(parent.key)
        parts.append(f"SELECT w.{spec.key} FROM {{waiting}} w LEFT SEMI JOIN {{t{i}}} t "
                     f"ON w.parent = '{name}' AND {match_key('w.code', parent.match)} = {match_key(f't.{parent.key}', parent.match)}")
    if not parts:
        parts.append(f"SELECT {spec.key} FROM {{waiting}} WHERE false")
    return waiting.sparkSession.sql(f"SELECT DISTINCT * FROM ({' UNION ALL '.join(parts)})", **tables)


def with_keys(rows: DataFrame, keys: DataFrame, spec: EntitySpec, how: str = "left semi") -> DataFrame:
    """The rows whose key is in `keys` (or, with "left anti", is not), compared as the entity's merge compares."""
    return rows.sparkSession.sql(
        "SELECT r.* FROM {rows} r " + _join(how, "{keys} k", " = ".join(match_key(f"{side}.{spec.key}", spec.match) for side in "rk")),
        rows=rows, keys=keys)
