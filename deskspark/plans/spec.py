"""What one entity looks like: columns, merge key, lookups, stamps."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from deskspark.functions.keys import BINARY, scoped_key

AUDIT = ("dt_inclusao", "dt_atualizacao", "nm_sistema_origem", "cd_registro_origem")

# Column types by name prefix, and the names that break the rule.
TYPE_BY_PREFIX = {
    "id": T.LongType(),
    "cd": T.StringType(),
    "nr": T.StringType(),
    "nm": T.StringType(),
    "ds": T.StringType(),
    "fl": T.BooleanType(),
    "qt": T.LongType(),
    "dt": T.TimestampNTZType(),
}
TYPE_BY_NAME = {
    "nr_score": T.IntegerType(),
    "Id": T.LongType(),
    "Column1": T.StringType(),
    "Column2": T.StringType(),
}


def column_type(name: str) -> T.DataType:
    return TYPE_BY_NAME.get(name) or TYPE_BY_PREFIX[name.split("_", 1)[0]]


def schema_of(names) -> T.StructType:
    return T.StructType([T.StructField(n, column_type(n), True) for n in names])


@dataclass(frozen=True)
class Lookup:
    """A foreign key: `column` holds the parent's id on either side, `code` is the
    name under which the parent's natural key travels in between."""

    parent: str
    column: str
    code: str
    required: bool = False

    @property
    def how(self) -> str:
        return "inner" if self.required else "left"


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    attributes: tuple[str, ...]
    surrogate: str | None = None
    lookups: tuple[Lookup, ...] = ()
    audit: tuple[str, ...] = AUDIT
    domain: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    seq: tuple[str, ...] | None = None
    match: str = BINARY
    scope: tuple[str, ...] = ()

    @property
    def key_columns(self) -> tuple[str, ...]:
        return (self.key, *self.scope)

    def merge_key(self, side: str = "") -> str:
        """The SQL form of what tells rows apart: the key, within `scope` where one system's keys say
        nothing about another's. A row without a key has none, whatever its scope."""
        return scoped_key(self.key, self.scope, self.match, side)

    @property
    def stamped(self) -> bool:
        return bool(self.audit)

    @property
    def insert_columns(self) -> tuple[str, ...]:
        return (*self.attributes, *(lk.column for lk in self.lookups), *self.audit)

    @property
    def update_columns(self) -> tuple[str, ...]:
        """Overwritten on a match; the stamp is handled apart."""
        fixed = {*self.key_columns, "dt_inclusao", "dt_atualizacao"}
        return tuple(c for c in self.insert_columns if c not in fixed)

    @property
    def extract_columns(self) -> tuple[str, ...]:
        return (*self.attributes, *(lk.code for lk in self.lookups), *self.audit)

    @property
    def target_columns(self) -> tuple[str, ...]:
        return ((self.surrogate,) if self.surrogate else ()) + self.insert_columns

    @property
    def order_columns(self) -> tuple[str, ...]:
        """A total order over rows of one key, standing in for arrival order."""
        seq = self.seq if self.seq is not None else (("dt_atualizacao",) if self.stamped else ())
        head = (*seq, *(("dt_inclusao",) if self.stamped else ()), self.key)
        return tuple(dict.fromkeys((*head, *self.insert_columns)))

    @property
    def source_schema(self) -> T.StructType:
        return schema_of(self.target_columns)

    @property
    def target_schema(self) -> T.StructType:
        return schema_of(self.target_columns)

    @property
    def extract_schema(self) -> T.StructType:
        return schema_of(self.extract_columns)

    def with_options(self, **changes) -> "EntitySpec":
        return replace(self, **changes)
