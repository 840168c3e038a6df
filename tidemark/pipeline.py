"""Passes over all planned tables: backfill from nothing, sync from the marks."""

from __future__ import annotations

import os
import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.cursor import TIMESTAMP, back, cursor_value, lag_seconds, later, max_cursor, parsed_mark
from .functions.predicates import compile_filters
from .operators.changes import changed
from .operators.quarantine import split
from .operators.store import Mark, TargetStore
from .plans.catalog import APPEND_ONLY, FOLLOW_PARENT, MUTABLE, OPEN_ROW, Catalog, Table
from .plans.resolve import Plan, TablePlan
from .plans.schema import INSTANCE, Change, LiveTable, desired, diff


@dataclass
class TableResult:
    table: str
    rows: int = 0
    quarantined: int = 0
    mark: str = ""
    seconds: float = 0.0


@dataclass
class Pass:
    tables: list[TableResult] = field(default_factory=list)
    error: Exception | None = None

    @property
    def rows(self) -> int:
        return sum(t.rows for t in self.tables)

    @property
    def quarantined(self) -> int:
        return sum(t.quarantined for t in self.tables)


class Runner:
    """Reads a source by a plan into a target store.

    open_row_source_side also reads the source's own unsettled rows, which finds rows that were never in the target.
    """

    def __init__(self, spark: SparkSession, source, store: TargetStore, plan: Plan, catalog: Catalog, instance: str, overlap: timedelta = timedelta(seconds=30), open_limit: int | None = None, open_row_source_side: bool = False, env: Mapping[str, str] = os.environ):
        self.spark, self.source, self.store, self.plan, self.catalog = spark, source, store, plan, catalog
        self.instance, self.overlap, self.open_limit, self.source_side, self.env = instance, overlap, open_limit, open_row_source_side, env

    def changes(self) -> list[Change]:
        """What the target's schema still needs; tables that the source lacks are skipped. Reads only."""
        live = self.source.reflect()
        return [c for p in self.plan.tables if p.name in live for c in diff(desired(p, live[p.name]), self.store.reflect(p.name))]

    def migrate(self) -> list[Change]:
        live, found = self.source.reflect(), self.changes()
        self.store.apply(found, {p.name: desired(p, live[p.name]) for p in self.plan.tables if p.name in live})
        return found

    def backfill(self) -> Pass:
        return self._each(lambda p, live: self._table(p, live, Mark()))

    def sync(self) -> Pass:
        marks = self.store.marks(self.instance)
        return self._each(lambda p, live: self._table(p, live, marks.get(p.name, Mark()), marks))

    def _each(self, work) -> Pass:
        """Table by table; the first error ends the pass, what was done before counts."""
        live, out = self.source.reflect(), Pass()
        for plan in self.plan.tables:
            if plan.name not in live:
                continue
            began = time.monotonic()
            try:
                result = work(plan, live[plan.name])
            except Exception as e:  # noqa: BLE001
                out.error = e
                break
            result.seconds = time.monotonic() - began
            out.tables.append(result)
        return out

    def _floor(self, table: Table, mark: str) -> tuple[str, str] | None:
        """What the source needn't read: of tables that are read by a timestamp mark alone, a second and more before it."""
        if table.follow not in (APPEND_ONLY, MUTABLE) or not table.cursor or table.cursor.kind != TIMESTAMP or parsed_mark(mark) is None:
            return None
        return table.cursor.column, back(table.cursor, mark, self.overlap + timedelta(seconds=1))

    def _filtered(self, plan: TablePlan, live: LiveTable, mark: str = "") -> DataFrame:
        table = plan.table
        needed = {*plan.columns(live.names), *(f.column for f in plan.filters), *(c for e in plan.extras.values() for c in e.references())}
        needed |= {table.cursor.column} if table.cursor else set()
        needed |= {table.state.column} if table.state and table.state.column in live.names else set()
        needed |= {table.parent.local} if table.parent else set()
        rows = self.source.read(table.name, [c for c in live.names if c in needed], self._floor(table, mark))
        return rows.where(compile_filters(plan.filters, rows.schema))

    def _table(self, plan: TablePlan, live: LiveTable, mark: Mark, marks: dict[str, Mark] | None = None) -> TableResult:
        table, now = plan.table, datetime.now(UTC)
        schema = desired(plan, live)
        filtered = self._filtered(plan, live, mark.value)
        follows, parent, parent_table = mark.value, None, None
        value = mark.value
        if not table.cursor and table.parent:
            # the parent's next mark is read before the rows, and stored with them
            parent_table = self.catalog.tables.get(table.parent.table)
            if parent_table and parent_table.cursor and table.parent.table in self.source.reflect():
                parent = self.source.read(table.parent.table, [table.parent.remote, parent_table.cursor.column])
                value = max_cursor(parent, parent_table.cursor)
        keys = None
        if table.follow == OPEN_ROW and mark.value and table.state and table.state.column in self.store.reflect(table.name):
            keys = self.store.open_keys(table.name, self.instance, table.key[0], table.state.column, table.state.terminal, self.open_limit)
        known = None
        if table.follow == FOLLOW_PARENT and mark.value and parent is not None and {*table.key} <= {*self.store.reflect(table.name)}:
            known = self.store.keys(table.name, self.instance, table.key)
        rows = changed(filtered, table, follows, self.overlap, keys, parent, parent_table, self.source_side, known)
        # one read: rows, their number and the next mark; all rows past the old mark are among them
        seen = Observation(f"{table.name}-{now.timestamp()}")
        latest = F.max(cursor_value(table.cursor)) if table.cursor else F.lit(None)
        staged, place = self.store.stage(rows.observe(seen, F.count("*").alias("rows"), latest.cast("string").alias("latest")))
        try:
            count = seen.get["rows"]
            if table.cursor:
                value = later(table.cursor, mark.value, seen.get["latest"] or "")
            good, bad = self._shaped(staged, plan, schema, live, now)
            # data, quarantine and mark land in one commit
            _, refused = self.store.write(table.name, good, bad, self.instance, Mark(table.cursor.kind if table.cursor else None, value, count), [F.col("_order")])
        finally:
            self.store.drop(place)
        return TableResult(table.name, count, refused, value)

    def _shaped(self, rows: DataFrame, plan: TablePlan, schema, live: LiveTable, now: datetime) -> tuple[DataFrame, DataFrame]:
        kept = plan.columns(live.names)
        extras = [e.column(rows.schema, plan.name, self.instance, now, self.env).alias(n) for n, e in sorted(plan.extras.items())]
        carried = [c for c in ("_order", "_refused") if c in rows.columns]
        shaped = rows.select(F.lit(self.instance).alias(INSTANCE), *(F.col(f"`{c}`") for c in kept), *extras, *carried)
        if "_refused" not in carried:
            return split(shaped, schema, kept, self.instance)
        good, bad = split(shaped.where("_refused is null").drop("_refused"), schema, kept, self.instance)
        wrong = shaped.where("_refused is not null")
        keys = [c for c in kept if c in schema.key]
        return good, bad.union(wrong.select(F.lit(self.instance), F.lit(plan.name), F.col(keys[-1]).cast("string"), "_refused", F.to_json(F.struct(*kept), {"ignoreNullFields": "false"})))

    def lags(self, now: datetime | None = None) -> dict[str, float]:
        marks, out = self.store.marks(self.instance), {}
        for p in self.plan.tables:
            if p.table.cursor and p.name in marks:
                lag = lag_seconds(p.table.cursor, marks[p.name].value, now or datetime.now(UTC))
                if lag is not None:
                    out[p.name] = lag
        return out
