"""How each known table is followed."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path

import yaml

from ..functions.cursor import INTEGER, TIMESTAMP, Cursor

APPEND_ONLY, MUTABLE, OPEN_ROW, FOLLOW_PARENT, SNAPSHOT = CLASSES = ("append_only", "mutable", "open_row", "follow_parent", "snapshot")
DEFAULT = Path(__file__).with_name("catalog.yaml")


@dataclass(frozen=True)
class State:
    column: str
    terminal: tuple[str, ...] = ()

    def is_terminal(self, value: str | None) -> bool:
        return value in self.terminal


@dataclass(frozen=True)
class Parent:
    table: str
    local: str
    remote: str


@dataclass(frozen=True)
class Table:
    name: str
    follow: str
    key: tuple[str, ...]
    cursor: Cursor | None = None
    state: State | None = None
    parent: Parent | None = None
    time_column: str | None = None
    timestamps: tuple[str, ...] = ()
    json_columns: tuple[str, ...] = ()
    large_columns: tuple[str, ...] = ()
    volume: str | None = None
    notes: str | None = None


@dataclass
class Catalog:
    tables: dict[str, Table] = field(default_factory=dict)
    schema_version: int = 1

    def names(self) -> list[str]:
        return sorted(self.tables)

    def problems(self) -> list[str]:
        found = [] if self.schema_version == 1 else [f"schema_version {self.schema_version} isn't supported"]
        for t in self.tables.values():
            say = lambda text, t=t: found.append(f"{t.name}: {text}")
            if t.follow not in CLASSES:
                say(f"unknown class {t.follow!r}")
            if not t.key:
                say("no key")
            if t.cursor and t.cursor.kind not in (INTEGER, TIMESTAMP):
                say(f"unknown cursor kind {t.cursor.kind!r}")
            if t.follow in (APPEND_ONLY, MUTABLE, OPEN_ROW) and not t.cursor:
                say(f"{t.follow} needs a cursor")
            if t.follow == MUTABLE and t.cursor and t.cursor.kind != TIMESTAMP:
                say("mutable needs a timestamp cursor")
            if t.follow == OPEN_ROW and not (t.state and t.state.terminal):
                say("open_row needs a state with terminal values")
            if t.follow == OPEN_ROW and len(t.key) != 1:
                say("open_row needs a key of one column")
            if t.follow == FOLLOW_PARENT and not t.parent:
                say("follow_parent needs a parent")
            if t.follow in (FOLLOW_PARENT, SNAPSHOT) and t.cursor:
                say(f"{t.follow} takes no cursor")
            if t.parent and t.parent.table not in self.tables:
                say(f"unknown parent {t.parent.table!r}")
        return found


def _strict(kind, raw: dict, where: str):
    unknown = set(raw) - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"{where}: unknown field {', '.join(sorted(unknown))}")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})


def parse(text: str) -> Catalog:
    raw = yaml.safe_load(text) or {}
    if unknown := set(raw) - {"schema_version", "tables"}:
        raise ValueError(f"unknown field {', '.join(sorted(unknown))}")
    tables: dict[str, Table] = {}
    for name, own in (raw.get("tables") or {}).items():
        own = dict(own, name=name)
        for part, kind in (("cursor", Cursor), ("state", State), ("parent", Parent)):
            if own.get(part):
                own[part] = _strict(kind, own[part], f"{name}.{part}")
        tables[name] = _strict(Table, own, name)
    found = Catalog(tables, raw.get("schema_version", 1))
    if problems := found.problems():
        raise ValueError("; ".join(problems))
    return found


def load(path: str | Path = DEFAULT) -> Catalog:
    return parse(Path(path).read_text(encoding="utf-8"))
