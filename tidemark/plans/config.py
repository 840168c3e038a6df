"""The configuration file: parsed strictly, defaulted, validated."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import timedelta
from pathlib import Path
from typing import Any

import yaml

from ..functions.predicates import Filter, valid_identifier
from ..functions.templates import Extra

_UNITS = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}
_DURATION = re.compile(r"([0-9]*\.?[0-9]+)(ns|us|µs|ms|s|m|h)")


def duration(text: str) -> timedelta:
    """As in 10s, 1m30s, 250ms."""
    found = _DURATION.findall(text)
    if not found or "".join(a + b for a, b in found) != text:
        raise ValueError(f"invalid duration {text!r}")
    return timedelta(seconds=sum(float(a) * _UNITS[b] for a, b in found))


def expand_env(text: str, env: Mapping[str, str] = os.environ) -> str:
    """``${env:NAME}`` in connection settings; a variable that isn't set is an error, and nothing else may stand there."""

    def value(m: re.Match) -> str:
        body = m[1]
        if not body.startswith("env:"):
            raise ValueError(f"only ${{env:NAME}} can be used here, not ${{{body}}}")
        if body[4:] not in env:
            raise ValueError(f"environment variable {body[4:]} is not set")
        return env[body[4:]]

    if re.search(r"\$\{[^}]*$", text):
        raise ValueError(f"unclosed ${{ in {text!r}")
    return re.sub(r"\$\{([^}]*)\}", value, text)


@dataclass
class Source:
    path: str = ""
    instance: str = ""
    wake: str | None = None


@dataclass
class Target:
    path: str = ""
    schema: str = "replica"


@dataclass
class Defaults:
    enabled: bool = True
    since: str | None = None
    until: str | None = None
    filters: list[Filter] = field(default_factory=list)
    exclude_columns: list[str] = field(default_factory=list)
    extra_fields: dict[str, Extra] = field(default_factory=dict)
    include_columns: list[str] = field(default_factory=list)


@dataclass
class TableConfig:
    enabled: bool | None = None
    filters: list[Filter] = field(default_factory=list)
    ignore_global_filters: bool = False
    include_columns: list[str] = field(default_factory=list)
    exclude_columns: list[str] = field(default_factory=list)
    extra_fields: dict[str, Extra] = field(default_factory=dict)
    json_columns: list[str] = field(default_factory=list)


@dataclass
class Config:
    source: Source = field(default_factory=Source)
    target: Target = field(default_factory=Target)
    interval: str = "10s"
    batch_size: int = 2000
    overlap: str = "30s"
    defaults: Defaults = field(default_factory=Defaults)
    tables: dict[str, TableConfig] = field(default_factory=dict)

    def problems(self) -> list[str]:
        found = [f"{name} is required" for name, v in (("source.path", self.source.path), ("source.instance", self.source.instance), ("target.path", self.target.path)) if not v]
        if not valid_identifier(self.target.schema):
            found.append(f"target.schema: invalid name {self.target.schema!r}")
        for name, text, least in (("interval", self.interval, True), ("overlap", self.overlap, False)):
            try:
                at = duration(text)
                if at < timedelta(0) or least and not at:
                    found.append(f"{name} must be positive")
            except ValueError as e:
                found.append(f"{name}: {e}")
        if self.batch_size <= 0:
            found.append("batch_size must be positive")
        if self.source.wake and not self.source.wake.startswith("unix://"):
            found.append("source.wake must be a unix:// address")
        d = self.defaults
        if d.include_columns:
            found.append("defaults.include_columns: columns can only be included per table")
        if d.since and d.until and not d.since < d.until:
            found.append("defaults.since must be before defaults.until")
        found += [p for f in d.filters for p in f.problems()]
        found += [p for n in sorted(d.extra_fields) for p in _extra_problems("defaults", n, d.extra_fields[n])]
        for name in sorted(self.tables):
            t = self.tables[name]
            if t.ignore_global_filters and not d.filters:
                found.append(f"{name}: ignore_global_filters without any global filter")
            found += [f"{name}: {p}" for f in t.filters for p in f.problems()]
            found += [p for n in sorted(t.extra_fields) for p in _extra_problems(name, n, t.extra_fields[n])]
        return found


def _extra_problems(where: str, name: str, extra: Extra) -> list[str]:
    found = [] if valid_identifier(name) else [f"{where}: invalid extra field name {name!r}"]
    return found + [f"{where}: {p}" for p in extra.problems(name)]


def _fields(kind, raw: Any, where: str, **convert):
    if not isinstance(raw, dict):
        raise ValueError(f"{where} must be a mapping")
    known = kind.__dataclass_fields__
    if unknown := set(raw) - set(known):
        raise ValueError(f"{where}: unknown field {', '.join(sorted(unknown))}")
    return kind(**{k: convert[k](v) if k in convert else v for k, v in raw.items() if v is not None})


def _filters(raw) -> list[Filter]:
    for f in raw:
        if not isinstance(f, dict) or set(f) - {"column", "op", "value"}:
            raise ValueError(f"a filter has column, op and value, not {f!r}")
    return [Filter(f.get("column", ""), f.get("op", ""), str(v) if hasattr(v := f.get("value"), "isoformat") else v) for f in raw]


def _extras(raw) -> dict[str, Extra]:
    return {n: Extra(str(v.get("value", "")), v.get("type")) if isinstance(v, dict) else Extra(str(v)) for n, v in raw.items()}


def parse(text: str, env: Mapping[str, str] = os.environ) -> Config:
    raw = yaml.safe_load(text) or {}
    own = {"filters": _filters, "extra_fields": _extras}
    tables = lambda v: {n: _fields(TableConfig, t or {}, n, **own) for n, t in v.items()}
    dated = lambda v: v.isoformat() if hasattr(v, "isoformat") else str(v)
    found = _fields(
        Config, raw, "config", source=lambda v: _fields(Source, v, "source"), target=lambda v: _fields(Target, v, "target"),
        defaults=lambda v: _fields(Defaults, v, "defaults", since=dated, until=dated, **own), tables=tables,
    )
    found.source.path, found.target.path = (expand_env(x, env) for x in (found.source.path, found.target.path))
    if problems := found.problems():
        raise ValueError("; ".join(problems))
    return found


def load(path: str | Path) -> Config:
    return parse(Path(path).read_text(encoding="utf-8"))
