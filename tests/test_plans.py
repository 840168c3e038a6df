from datetime import timedelta

import pytest

from tidemark.plans import catalog as catalogs
from tidemark.plans import config as configs
from tidemark.plans.resolve import TablePlan, resolve
from tidemark.plans.schema import INSTANCE, LiveTable, desired, diff, drift

BASE = "source: {path: /s.db, instance: here}\ntarget: {path: /t}\n"


def test_default_catalog():
    found = catalogs.load()
    assert len(found.tables) == 23
    assert sorted(sum(t.follow == c for t in found.tables.values()) for c in catalogs.CLASSES) == [2, 2, 5, 6, 8]
    assert found.tables["step_runs"].state.is_terminal("skipped")


@pytest.mark.parametrize(
    "text",
    ["tables: {a: {follow: odd, key: [id]}}", "tables: {a: {follow: append_only, key: [id]}}", "tables: {a: {follow: snapshot, key: []}}", "tables: {a: {follow: open_row, key: [id], cursor: {column: id, kind: integer}}}",
     "tables: {a: {follow: follow_parent, key: [id]}}", "tables: {a: {follow: snapshot, key: [id], odd: 1}}", "tables: {a: {follow: append_only, key: [id], cursor: {column: id, kind: text}}}", "schema_version: 2"],
)
def test_bad_catalogs(text):
    with pytest.raises(ValueError):
        catalogs.parse(text)


def test_durations():
    assert configs.duration("1m30s") == timedelta(seconds=90)
    assert configs.duration("250ms") == timedelta(milliseconds=250)
    for text in ("", "5", "x", "5 s"):
        with pytest.raises(ValueError):
            configs.duration(text)


def test_environment():
    assert configs.expand_env("a${env:X}b", {"X": "1"}) == "a1b"
    for text in ("${env:GONE}", "${now}", "${env:X"):
        with pytest.raises(ValueError):
            configs.expand_env(text, {"X": "1"})


def test_defaults():
    c = configs.parse(BASE)
    assert (c.interval, c.batch_size, c.overlap, c.target.schema, c.defaults.enabled) == ("10s", 2000, "30s", "replica", True)


@pytest.mark.parametrize(
    "text",
    ["odd: 1", "interval: 0s", "batch_size: 0", "defaults: {include_columns: [a]}", "defaults: {since: 2026-02-01, until: 2026-01-01}", "tables: {tasks: {ignore_global_filters: true}}",
     "tables: {tasks: {filters: [{column: a, op: near, value: 1}]}}", "defaults: {extra_fields: {x: '${odd}'}}"],
)
def test_bad_configs(text):
    with pytest.raises(ValueError):
        configs.parse(BASE + text)


def plan_of(text, name="tasks"):
    plan = resolve(configs.parse(BASE + text), catalogs.load())
    return next((t for t in plan.tables if t.name == name), None), plan


def test_resolution():
    t, plan = plan_of("""
defaults:
  since: 2026-01-01
  filters: [{column: state, op: ne, value: x}]
  exclude_columns: [output]
  extra_fields: {site: here, at: '${now}'}
tables:
  tasks: {filters: [{column: id, op: not_null}], exclude_columns: [title], extra_fields: {site: there}}
  agents: {enabled: false}
  internal_tasks: {ignore_global_filters: true, json_columns: [extra]}
""")
    assert [f.column for f in t.filters] == ["created_at", "state", "id"] and t.filters[0].or_null
    assert t.exclude == {"output", "title"} and t.extras["site"].template == "there" and "at" in t.extras
    assert "agents" not in [p.name for p in plan.tables] and [p.name for p in plan.tables] == sorted(p.name for p in plan.tables)
    assert plan.unwindowed == ["improvement_findings", "pr_event_dispatches", "pr_event_watermarks"]
    other = next(p for p in plan.tables if p.name == "internal_tasks")
    assert other.filters == [] and other.json_columns == ["extra", "input", "metadata"]
    assert [p.name for p in plan.restrict(["tasks"]).tables] == ["tasks"]
    with pytest.raises(ValueError):
        plan.restrict(["agents"])


@pytest.mark.parametrize("text", ["tables: {odd: {}}", "tables: {tasks: {exclude_columns: [id]}}", "tables: {tasks: {include_columns: [id]}}", "defaults: {enabled: false}"])
def test_unresolvable(text):
    with pytest.raises(ValueError):
        plan_of(text)


def test_columns_and_check():
    t, plan = plan_of("tables: {tasks: {include_columns: [updated_at, id, gone], extra_fields: {copy: '${row.title}', id2: '${row.odd}', id: x}, filters: [{column: nope, op: not_null}]}}")
    assert t.columns(["id", "title", "updated_at"]) == ["updated_at", "id"]
    assert len(plan.check({"tasks": ["id", "title", "updated_at"]})) == 5


def test_drift():
    catalog = catalogs.parse("tables: {a: {follow: append_only, key: [id], cursor: {column: seq, kind: integer}, json_columns: [j]}, b: {follow: snapshot, key: [id]}}")
    found = drift(catalog, {"a": LiveTable("a", [("id", "INTEGER"), ("more", "TEXT")], ["id", "more"]), "c": LiveTable("c")})
    assert [(f.level, f.table) for f in found] == [("error", "a"), ("warning", "a"), ("warning", "a"), ("warning", "b"), ("warning", "c")]


def test_desired_and_diff():
    table = catalogs.Table("a", "snapshot", ("id",))
    live = LiveTable("a", [("id", "INTEGER"), ("x", "TEXT")], ["id"])
    plan = TablePlan(table, extras={"z": configs.Extra("${now}"), "b": configs.Extra("q")})
    schema = desired(plan, live)
    assert [c.name for c in schema.columns] == [INSTANCE, "id", "x", "b", "z"] and schema.key == [INSTANCE, "id"]
    assert [c.kind for c in diff(schema, {})] == ["create"]
    assert [c.kind for c in diff(schema, {c.name: c.type for c in schema.columns} | {"more": "text"})] == []
    assert [c.kind for c in diff(schema, {INSTANCE: "text", "id": "text", "x": "text", "b": "text"})] == ["blocked", "add"]
    with pytest.raises(ValueError):
        desired(TablePlan(table, exclude={"id"}), live)
    with pytest.raises(ValueError):
        desired(TablePlan(table), LiveTable("a", [("id", "INTEGER"), (INSTANCE, "TEXT")]))
    with pytest.raises(ValueError):
        desired(TablePlan(table, extras={"x": configs.Extra("q")}), live)
