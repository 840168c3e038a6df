"""A configuration and a catalog become the plan of each table."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.predicates import Filter
from ..functions.templates import Extra
from .catalog import Catalog, Table
from .config import Config, TableConfig


@dataclass
class TablePlan:
    table: Table
    filters: list[Filter] = field(default_factory=list)
    include: list[str] = field(default_factory=list)
    exclude: set[str] = field(default_factory=set)
    extras: dict[str, Extra] = field(default_factory=dict)
    json_columns: list[str] = field(default_factory=list)

    @property
    def name(self) -> str:
        return self.table.name

    def columns(self, live: list[str]) -> list[str]:
        """Included columns as listed, or all live ones; less the excluded."""
        named = [c for c in self.include if c in live] if self.include else list(live)
        return [c for c in named if c not in self.exclude]


@dataclass
class Plan:
    tables: list[TablePlan]
    unwindowed: list[str] = field(default_factory=list)

    def restrict(self, names: list[str]) -> Plan:
        """Only these tables, which must be enabled ones."""
        known = {t.name for t in self.tables}
        if missing := sorted(set(names) - known):
            raise ValueError(f"not enabled: {', '.join(missing)}")
        return Plan([t for t in self.tables if not names or t.name in names], self.unwindowed)

    def absent(self, live) -> list[str]:
        """Planned tables that the source lacks; they are skipped."""
        return [t.name for t in self.tables if t.name not in live]

    def check(self, live: dict[str, list[str]]) -> list[str]:
        """Problems of the plan with the source's columns; tables that the source lacks are skipped."""
        found = []
        for t in self.tables:
            columns = live.get(t.name)
            if columns is None:
                continue
            kept = set(t.columns(columns))
            found += [f"{t.name}: filter on unknown column {f.column}" for f in t.filters if f.column not in columns]
            found += [f"{t.name}: unknown column {c} is included" for c in t.include if c not in columns]
            for name, extra in sorted(t.extras.items()):
                if name in columns:
                    found.append(f"{t.name}: extra field {name} is also a column")
                for c in extra.references():
                    if c not in columns:
                        found.append(f"{t.name}: extra field {name} reads unknown column {c}")
                    elif c not in kept:
                        found.append(f"{t.name}: extra field {name} reads column {c}, which isn't replicated")
        return found


def _window(config: Config, table: Table) -> list[Filter]:
    d, c = config.defaults, table.time_column
    if not c:
        return []
    return [Filter(c, "gte", d.since, True)] * bool(d.since) + [Filter(c, "lt", d.until, True)] * bool(d.until)


def resolve(config: Config, catalog: Catalog) -> Plan:
    problems = [f"unknown table {n}" for n in sorted(config.tables) if n not in catalog.tables]
    plans, unwindowed, d = [], [], config.defaults
    for name in catalog.names():
        table, own = catalog.tables[name], config.tables.get(name, TableConfig())
        if not (d.enabled if own.enabled is None else own.enabled):
            continue
        shared = [] if own.ignore_global_filters else [*_window(config, table), *d.filters]
        plan = TablePlan(table, [*shared, *own.filters], own.include_columns, {*d.exclude_columns, *own.exclude_columns}, {**d.extra_fields, **own.extra_fields}, sorted({*table.json_columns, *own.json_columns}))
        needed = [*table.key, *([table.cursor.column] if table.cursor else [])]
        problems += [f"{name}: column {c} is needed and can't be left out" for c in needed if c in plan.exclude or plan.include and c not in plan.include]
        if (d.since or d.until) and not table.time_column:
            unwindowed.append(name)
        plans.append(plan)
    if not plans:
        problems.append("no table is enabled")
    if problems:
        raise ValueError("; ".join(problems))
    return Plan(plans, unwindowed)
