"""Live schemas, drift against the catalog, and the target's schema: wanted, compared, written down."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from ..functions.types import map_column, spark_type
from .catalog import OPEN_ROW, Catalog
from .resolve import TablePlan

#: First key column of every target table: which source a row is from.
INSTANCE = "source_instance"


@dataclass
class LiveTable:
    """A source table as it is now: (column, declared type) in order, and the primary key in key order."""

    name: str
    columns: list[tuple[str, str]] = field(default_factory=list)
    key: list[str] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]


@dataclass(frozen=True, order=True)
class Finding:
    level: str
    table: str
    text: str

    def __str__(self) -> str:
        return f"{self.level}: {self.table}: {self.text}"


def drift(catalog: Catalog, live: dict[str, LiveTable]) -> list[Finding]:
    """Where the source isn't as the catalog says; columns beyond the catalog's are fine. Errors first, then by table."""
    found = []
    for name, t in catalog.tables.items():
        own = live.get(name)
        if own is None:
            found.append(Finding("warning", name, "the source has no such table"))
            continue
        need = [(c, "key") for c in t.key] + ([(t.cursor.column, "cursor")] if t.cursor else []) + ([(t.parent.local, "parent")] if t.parent else [])
        if t.state and t.follow == OPEN_ROW:
            need.append((t.state.column, "state"))
        elif t.state and t.state.column not in own.names:
            found.append(Finding("warning", name, f"state column {t.state.column} is missing"))
        found += [Finding("error", name, f"{what} column {c} is missing") for c, what in need if c not in own.names]
        if t.parent and t.parent.table not in live:
            found.append(Finding("error", name, f"parent table {t.parent.table} is missing"))
        elif t.parent and t.parent.remote not in live[t.parent.table].names:
            found.append(Finding("error", name, f"parent column {t.parent.table}.{t.parent.remote} is missing"))
        if own.key and set(own.key) != set(t.key):
            found.append(Finding("warning", name, f"primary key is ({', '.join(own.key)}), not ({', '.join(t.key)})"))
        soft = [*((c, "timestamp") for c in t.timestamps), *((c, "json") for c in t.json_columns), *((c, "large") for c in t.large_columns)]
        found += [Finding("warning", name, f"{what} column {c} is missing") for c, what in soft if c not in own.names]
    found += [Finding("warning", name, "not in the catalog") for name in live if name not in catalog.tables]
    return sorted(found, key=lambda f: (f.level != "error", f.table))


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    key: bool = False


@dataclass(frozen=True)
class TargetSchema:
    table: str
    columns: tuple[Column, ...]

    @property
    def key(self) -> list[str]:
        return [c.name for c in self.columns if c.key]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, spark_type(c.type), not c.key) for c in self.columns])


def desired(plan: TablePlan, live: LiveTable, instance: str = INSTANCE) -> TargetSchema:
    """Instance, the source's columns in its order, extra fields by name; key: instance and the catalog's."""
    kept, declared = plan.columns(live.names), dict(live.columns)
    for name in (*kept, *plan.extras):
        if name == instance:
            raise ValueError(f"{plan.name}: {instance} is reserved")
    if both := sorted(set(kept) & set(plan.extras)):
        raise ValueError(f"{plan.name}: extra fields collide with columns: {', '.join(both)}")
    if missing := [c for c in plan.table.key if c not in kept]:
        raise ValueError(f"{plan.name}: key columns aren't replicated: {', '.join(missing)}")
    columns = [Column(instance, "text", True)]
    columns += [Column(c, map_column(c, declared[c], plan.json_columns), c in plan.table.key) for c in kept]
    columns += [Column(c, plan.extras[c].resolved_type()) for c in sorted(plan.extras)]
    return TargetSchema(plan.name, tuple(columns))


@dataclass(frozen=True)
class Change:
    kind: str  # create, add, blocked
    table: str
    sql: str
    reason: str = ""


def _sql(c: Column) -> str:
    return f"`{c.name}` {spark_type(c.type).simpleString().upper()}" + " NOT NULL" * c.key


def create_sql(schema: TargetSchema, database: str) -> str:
    return f"CREATE TABLE {database}.{schema.table} ({', '.join(map(_sql, schema.columns))}) USING parquet"


def add_column_sql(table: str, column: Column, database: str) -> str:
    return f"ALTER TABLE {database}.{table} ADD COLUMN `{column.name}` {spark_type(column.type).simpleString().upper()}"


def diff(wanted: TargetSchema, existing: dict[str, str], database: str = "replica") -> list[Change]:
    """Only additions happen; another type blocks; columns beyond the wanted ones are left alone."""
    if not existing:
        return [Change("create", wanted.table, create_sql(wanted, database))]
    out = []
    for c in wanted.columns:
        if c.name not in existing:
            out.append(Change("add", wanted.table, add_column_sql(wanted.table, c, database)))
        elif existing[c.name] != c.type:
            out.append(Change("blocked", wanted.table, "", f"{c.name} is {existing[c.name]}, not {c.type}"))
    return out
