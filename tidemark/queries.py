"""Queries over the standard tables that exercise each operator, with equivalent SQL."""

from __future__ import annotations

import sqlite3
import uuid
from collections.abc import Callable
from contextlib import closing
from datetime import UTC, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import reports
from .functions.convert import convert, refusal
from .functions.cursor import INTEGER, TIMESTAMP, Cursor, advance, back, cursor_value, lag_seconds, max_cursor, open_rows
from .functions.predicates import Filter, compile_filters
from .functions.templates import Extra
from .operators import changes
from .operators.quarantine import split
from .operators.store import TargetStore
from .operators.upsert import last_writer, upsert
from .pipeline import Runner
from .plans import catalog as catalogs
from .plans import config as configs
from .plans.catalog import Catalog, Parent, State, Table
from .plans.resolve import Plan, TablePlan, resolve
from .plans.schema import INSTANCE, LiveTable, desired, diff, drift
from .sources.frames import FrameSource
from .sources.sqlite import SqliteSource
from .streaming.loop import Loop
from .streaming.metrics import Metrics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# predicates, on orders whose status P is null

_STATUS = "nullif(o_orderstatus, 'P')"


def _orders(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.expr(_STATUS).alias("status"), "o_totalprice", "o_orderdate")


_FILTERS = {
    "filter_eq": (Filter("status", "eq", "F"), "status = 'F'"),
    "filter_ne_admits_null": (Filter("status", "ne", "F"), "status <> 'F' OR status IS NULL"),
    "filter_in": (Filter("status", "in", ["F", "X"]), "status IN ('F', 'X')"),
    "filter_not_in_admits_null": (Filter("status", "not_in", ["F", "X"]), "status NOT IN ('F', 'X') OR status IS NULL"),
    "filter_lt": (Filter("o_totalprice", "lt", 150000.0), "o_totalprice < 150000.0"),
    "filter_lte": (Filter("o_orderkey", "lte", 500), "o_orderkey <= 500"),
    "filter_gt": (Filter("o_totalprice", "gt", 400000.0), "o_totalprice > 400000.0"),
    "filter_gte": (Filter("o_orderkey", "gte", 500), "o_orderkey >= 500"),
    "filter_is_null": (Filter("status", "is_null"), "status IS NULL"),
    "filter_not_null": (Filter("status", "not_null"), "status IS NOT NULL"),
}
for _name, (_filter, _sql) in _FILTERS.items():
    query(f"SELECT o_orderkey, status, o_totalprice FROM (SELECT o_orderkey, {_STATUS} AS status, o_totalprice FROM orders) WHERE {_sql}", _name)(
        lambda spark, sf_dir, f=_filter: _orders(spark, sf_dir).where(compile_filters([f])).select("o_orderkey", "status", "o_totalprice")
    )


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE 's%ing'")
def filter_like_ci(spark, sf_dir):
    return _t(spark, sf_dir, "part").where(compile_filters([Filter("p_name", "like", "S%ING")])).select("p_partkey", "p_name")


@query("SELECT event_id, ts FROM (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN ts END AS ts FROM events) WHERE ts >= (SELECT min(ts) + INTERVAL 10 DAY FROM events) OR ts IS NULL")
def filter_or_null_window(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    since = events.agg(F.min("ts")).first()[0] + timedelta(days=10)
    nulled = events.select("event_id", F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("ts"))
    return nulled.where(compile_filters([Filter("ts", "gte", since, or_null=True)]))


# projection


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def project_include_exclude(spark, sf_dir):
    df = _t(spark, sf_dir, "customer")
    plan = TablePlan(Table("customer", "snapshot", ("c_custkey",)), include=["c_custkey", "c_name", "c_mktsegment", "c_acctbal", "gone"], exclude={"c_acctbal"})
    return df.select(*plan.columns(df.columns))


@query("SELECT 'laptop' AS source_instance, c_custkey, c_name, c_mktsegment FROM customer")
def instance_key(spark, sf_dir):
    df = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    live = LiveTable("customer", [("c_custkey", "INTEGER"), ("c_name", "TEXT"), ("c_mktsegment", "TEXT")], ["c_custkey"])
    schema = desired(TablePlan(Table("customer", "snapshot", ("c_custkey",))), live)
    good, _ = split(df.select(F.lit("laptop").alias(INSTANCE), *df.columns), schema, df.columns, "laptop")
    return good.select(*(c.name for c in schema.columns))


# cursors and marks

_EVENT_ID, _TS = Cursor("event_id", INTEGER), Cursor("ts", TIMESTAMP)


@query("SELECT max(event_id) AS mark FROM events WHERE event_type <> 'purchase'")
def watermark_max(spark, sf_dir):
    return _t(spark, sf_dir, "events").where(compile_filters([Filter("event_type", "ne", "purchase")])).agg(F.max(cursor_value(_EVENT_ID)).alias("mark"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS mark FROM events")
def watermark_normalised(spark, sf_dir):
    # whole milliseconds: DuckDB's %g cuts where marks round
    events = _t(spark, sf_dir, "events").withColumn("ts", F.date_trunc("millisecond", "ts"))
    return events.select("event_id", cursor_value(_TS).alias("mark"))


@query("SELECT epoch_us(TIMESTAMP '2030-01-01') - epoch_us(max(ts)) AS lag_micros FROM events")
def lag_micros(spark, sf_dir):
    return _t(spark, sf_dir, "events").agg((F.unix_micros(F.lit("2030-01-01").cast("timestamp")) - F.unix_micros(F.max("ts").cast("timestamp"))).alias("lag_micros"))


# change capture

_EVENTS = Table("events", "append_only", ("event_id",), _EVENT_ID)
_MUTABLE = Table("events", "mutable", ("event_id",), _TS)
_OPEN = Table("orders", "open_row", ("o_orderkey",), Cursor("o_orderkey", INTEGER), State("o_orderstatus", ("F",)))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_id > (SELECT max(event_id) FROM events) * 9 // 10")
def append_only_advance(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    mark = str(int(max_cursor(events, _EVENT_ID)) * 9 // 10)
    return changes.changed(events, _EVENTS, mark, timedelta(0)).select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id FROM events WHERE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') >= (SELECT strftime(max(ts) - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S.%g') FROM events)")
def mutable_overlap(spark, sf_dir):
    events = _t(spark, sf_dir, "events").withColumn("ts", F.date_trunc("millisecond", "ts"))
    return changes.changed(events, _MUTABLE, max_cursor(events, _TS), timedelta(days=1)).select("event_id", "user_id")


@query(f"SELECT o_orderkey, status FROM (SELECT o_orderkey, {_STATUS} AS status FROM orders) WHERE status IS NULL OR status NOT IN ('F')")
def open_row_predicate(spark, sf_dir):
    return _orders(spark, sf_dir).where(open_rows("status", ("F",))).select("o_orderkey", "status")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders) // 2 OR o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus <> 'F')")
def open_row_rescan(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    held = orders.where("o_orderkey % 3 = 0 AND o_orderstatus <> 'F'").select("o_orderkey")  # what the target holds unsettled
    mark = str(int(max_cursor(orders, _OPEN.cursor)) // 2)
    return changes.changed(orders, _OPEN, mark, timedelta(0), held).select("o_orderkey", "o_orderstatus")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')")
def follow_parent(spark, sf_dir):
    link = Parent("orders", "l_orderkey", "o_orderkey")
    child = Table("lineitem", "follow_parent", ("l_orderkey", "l_linenumber"), parent=link)
    parent = Table("orders", "mutable", ("o_orderkey",), Cursor("o_orderdate", TIMESTAMP))
    found = changes.changed(_t(spark, sf_dir, "lineitem"), child, "1998-01-01 00:00:00.000", timedelta(0), parent=_t(spark, sf_dir, "orders"), parent_table=parent)
    return found.select("l_orderkey", "l_linenumber", "l_partkey")


# upsert


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN upper(n_name) ELSE lower(n_name) END AS n_name FROM nation")
def snapshot_upsert(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    incoming = nation.where("n_nationkey % 2 = 0").withColumn("n_name", F.upper("n_name"))
    return upsert(nation.withColumn("n_name", F.lower("n_name")), incoming, ["n_nationkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def upsert_update_insert(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return upsert(orders.where("o_orderkey % 3 = 0"), orders.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("new")), ["o_orderkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders")
def upsert_null_overwrites(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return upsert(orders, orders.where("o_orderkey % 5 = 0").withColumn("o_orderpriority", F.lit(None).cast("string")), ["o_orderkey"])


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def upsert_all_key_noop(spark, sf_dir):
    pairs = _t(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    return upsert(pairs, pairs.where("c_nationkey % 2 = 0"), ["c_nationkey", "c_mktsegment"])


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in _LINE_ORDER)}) AS place FROM lineitem) WHERE place = 1")
def last_writer_wins(spark, sf_dir):
    return last_writer(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in _LINE_ORDER]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def idempotent_replay(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    once = upsert(orders.where("o_orderkey % 2 = 0"), orders, ["o_orderkey"])
    return upsert(once, orders.where("o_orderkey % 7 = 0"), ["o_orderkey"])


@query("SELECT 'a' AS source_instance, r_regionkey, r_name FROM region UNION ALL SELECT 'b', r_regionkey, upper(r_name) FROM region")
def two_instances(spark, sf_dir):
    region = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    a, b = region.select(F.lit("a").alias(INSTANCE), "r_regionkey", "r_name"), region.select(F.lit("b").alias(INSTANCE), "r_regionkey", F.upper("r_name").alias("r_name"))
    return upsert(a, b, [INSTANCE, "r_regionkey"])


# quarantine and conversion

_POISONED = "CASE WHEN event_id % 7 = 0 THEN 'this is not json' WHEN event_id % 11 = 0 THEN '  ' ELSE props END"


def _split(spark, sf_dir):
    df = _t(spark, sf_dir, "events").select("event_id", F.expr(_POISONED).alias("props"))
    live = LiveTable("events", [("event_id", "INTEGER"), ("props", "TEXT")], ["event_id"])
    schema = desired(TablePlan(_EVENTS, json_columns=["props"]), live)
    return split(df.withColumn(INSTANCE, F.lit("a")), schema, ["event_id", "props"], "a")


@query(f"SELECT CAST(event_id AS VARCHAR) AS row_key, 'events' AS table_name, 'invalid input for type json: props' AS error_message FROM (SELECT event_id, {_POISONED} AS props FROM events) WHERE trim(props) <> '' AND NOT json_valid(props)")
def quarantine_split(spark, sf_dir):
    return _split(spark, sf_dir)[1].select("row_key", "table_name", "error_message")


@query(f"SELECT event_id, nullif(trim(props), '') AS props FROM (SELECT event_id, {_POISONED} AS props FROM events) WHERE trim(props) = '' OR json_valid(props)")
def quarantine_rest_lands(spark, sf_dir):
    return _split(spark, sf_dir)[0].select("event_id", "props")


@query("SELECT doc_id, quality <> 0 AS good FROM labels")
def convert_bool(spark, sf_dir):
    return _t(spark, sf_dir, "labels").select("doc_id", convert(F.col("quality"), T.IntegerType(), "boolean").alias("good"))


@query("SELECT event_id, epoch_us(ts) AS at_micros FROM events")
def convert_legacy_timestamp(spark, sf_dir):
    local = F.date_format(F.col("ts") - F.expr("INTERVAL 4 HOURS"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_id") % 2 == 0, F.concat(local, F.lit(" -0400 EDT m=+0.123"))).otherwise(F.concat(local, F.lit("-04:00")))
    return _t(spark, sf_dir, "events").select("event_id", F.unix_micros(convert(text, T.StringType(), "timestamptz")).alias("at_micros"))


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN epoch_us(ts) END AS at_micros FROM events")
def unparseable_to_null(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 == 0, F.lit("not a timestamp at all")).otherwise(F.col("ts").cast("string"))
    return _t(spark, sf_dir, "events").select("event_id", F.unix_micros(convert(text, T.StringType(), "timestamptz")).alias("at_micros"))


@query("SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN props END AS props FROM events")
def blank_json_to_null(spark, sf_dir):
    text = F.when(F.col("event_id") % 11 == 0, F.lit(" ")).otherwise(F.col("props"))
    return _t(spark, sf_dir, "events").select("event_id", convert(text, T.StringType(), "jsonb").alias("props"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


# enrichment


@query("SELECT event_id, 'events from laptop' AS origin, 7 AS version FROM events")
def enrich_constant(spark, sf_dir):
    df, now = _t(spark, sf_dir, "events"), datetime(2026, 1, 1)
    origin = Extra("${table} from ${source.instance}").column(df.schema, "events", "laptop", now, {})
    return df.select("event_id", origin.alias("origin"), Extra("7", "bigint").column(df.schema, "events", "laptop", now, {}).cast("int").alias("version"))


@query("SELECT event_id, event_type || '/' || CAST(user_id AS VARCHAR) AS label FROM events")
def enrich_row_template(spark, sf_dir):
    df = _t(spark, sf_dir, "events")
    return df.select("event_id", Extra("${row.event_type}/${row.user_id}").column(df.schema, "events", "laptop", datetime(2026, 1, 1), {}).alias("label"))


# schemas

_CATALOG = Catalog({
    "orders": Table("orders", "open_row", ("id",), Cursor("seq", INTEGER), State("status", ("done",))),
    "lines": Table("lines", "follow_parent", ("id",), parent=Parent("orders", "order_id", "id"), json_columns=("payload",)),
    "gone": Table("gone", "snapshot", ("id",)),
})


@query("SELECT * FROM (VALUES ('error', 'orders', 'cursor column seq is missing'), ('warning', 'gone', 'the source has no such table'), ('warning', 'lines', 'json column payload is missing'), ('warning', 'lines', 'primary key is (id, n), not (id)'), ('warning', 'new', 'not in the catalog')) AS t(level, table_name, finding)")
def drift_findings(spark, sf_dir):
    live = {
        "orders": LiveTable("orders", [("id", "INTEGER"), ("status", "TEXT"), ("added", "TEXT")], ["id"]),
        "lines": LiveTable("lines", [("id", "INTEGER"), ("n", "INTEGER"), ("order_id", "INTEGER")], ["id", "n"]),
        "new": LiveTable("new", [("id", "INTEGER")], ["id"]),
    }
    return spark.createDataFrame([(f.level, f.table, f.text) for f in drift(_CATALOG, live)], "level string, table_name string, finding string")


@query("SELECT * FROM (VALUES ('add', 'ALTER TABLE replica.orders ADD COLUMN `seq` BIGINT', ''), ('blocked', '', 'status is bigint, not text')) AS t(kind, ddl, reason)")
def ddl_diff(spark, sf_dir):
    live = LiveTable("orders", [("id", "INTEGER"), ("status", "TEXT"), ("seq", "INTEGER")], ["id"])
    found = diff(desired(TablePlan(_CATALOG.tables["orders"]), live), {INSTANCE: "text", "id": "bigint", "status": "bigint", "extra": "text"})
    return spark.createDataFrame([(c.kind, c.sql, c.reason) for c in found], "kind string, ddl string, reason string")


# reports


@query("SELECT CAST(user_id AS VARCHAR) AS agent_id, count(*) AS runs, round(sum(cents) / 100.0, 2) AS cost, CAST(sum(event_id % 1000) AS BIGINT) AS tokens FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events) WHERE event_type = (SELECT min(event_type) FROM events) AND ts >= (SELECT max(ts) FROM events) - INTERVAL 30 DAY GROUP BY user_id")
def report_cost_by_agent(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    latest, kind = events.agg(F.max("ts"), F.min("event_type")).first()
    cents = F.round(F.col("value") * 100).cast("bigint")
    executions = events.select(
        F.col("user_id").cast("string").alias("agent_id"), F.when(F.col("event_type") == kind, "success").otherwise("failed").alias("status"),
        F.col("ts").alias("created_at"), (cents.cast("decimal(20,0)") / 100).alias("cost_usd"), (F.col("event_id") % 1000).alias("total_tokens"),
    )
    return reports.cost_by_agent(executions, latest).withColumn("cost", F.col("cost").cast("double"))


@query("SELECT event_type AS step_id, count(*) AS runs, round(avg(event_id % 1000)) AS avg_tokens, round(avg(user_id % 100), 1) AS avg_seconds FROM events WHERE event_id % 10 <> 0 GROUP BY event_type")
def report_by_step(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    start = F.col("ts").cast("timestamp")
    steps = events.select(
        F.col("event_type").alias("step_id"), F.when(F.col("event_id") % 10 != 0, "passed").otherwise("failed").alias("state"), start.alias("started_at"),
        F.timestamp_micros(F.unix_micros(start) + (F.col("user_id") % 100) * 1_000_000).alias("finished_at"), (F.col("event_id") % 1000).alias("total_tokens"),
    )
    return reports.by_step(steps)


@query("SELECT 'events' AS table_name, CAST(event_id AS VARCHAR) AS row_key FROM events WHERE event_id % 7 = 0")
def report_quarantine(spark, sf_dir):
    bad = _split(spark, sf_dir)[1].withColumn("quarantined_at", F.lit("2026-01-01").cast("timestamp"))
    return reports.quarantine(bad).select("table_name", "row_key")


@query("SELECT 'a' AS source_instance, o_orderkey, o_orderstatus, o_totalprice FROM orders")
def backfill_then_sync(spark, sf_dir):
    """A store that is filled from the orders as they were, then follows them: open ones settle and new ones come."""
    store = _temporary_store(spark)
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    middle = orders.agg(F.max("o_orderkey")).first()[0] // 2
    early = orders.where(F.col("o_orderkey") <= middle).withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, "O").otherwise(F.col("o_orderstatus")))
    early = early.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(F.lit(0.0)))
    plan = Plan([TablePlan(_OPEN)])
    catalog = Catalog({"orders": _OPEN})
    for df in (early, orders):
        runner = Runner(spark, FrameSource({"orders": df}, {"orders": ["o_orderkey"]}), store, plan, catalog, "a", env={})
        runner.migrate()
        done = runner.sync()
        if done.error:
            raise done.error
    return store.read("orders").select(INSTANCE, "o_orderkey", "o_orderstatus", "o_totalprice")


def _temporary_store(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/tidemark-checkpoints"
    return TargetStore(spark, f"{root.rstrip('/')}/store-{uuid.uuid4().hex}", buckets=8)


@query("SELECT event_id FROM events WHERE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') > (SELECT strftime(max(ts) - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S.%g') FROM events)")
def advance_exclusive(spark, sf_dir):
    events = _t(spark, sf_dir, "events").withColumn("ts", F.date_trunc("millisecond", "ts"))
    return events.where(advance(_TS, back(_TS, max_cursor(events, _TS), timedelta(hours=2)))).select("event_id")


# operators on the cases that the queries above leave out


@query("SELECT CAST(epoch_ms(TIMESTAMP '2030-01-01') - max((epoch_us(ts) + 500) // 1000) AS BIGINT) AS lag_millis FROM events")
def lag_of_mark(spark, sf_dir):
    """The lag of the mark that a pass would store."""
    lag = lag_seconds(_TS, max_cursor(_t(spark, sf_dir, "events"), _TS), datetime(2030, 1, 1, tzinfo=UTC))
    return spark.createDataFrame([(round(lag * 1000),)], "lag_millis long")


@query("SELECT event_id, strftime(make_timestamp((epoch_us(ts) + 500) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%g') AS mark FROM events")
def watermark_rounding(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", cursor_value(_TS).alias("mark"))


@query("SELECT event_id FROM events WHERE (epoch_us(ts) + 500) // 1000 > (SELECT max((epoch_us(ts) + 500) // 1000) - 7200000 FROM events)")
def advance_native(spark, sf_dir):
    """A native timestamp against a mark, which files can be pruned by."""
    events = _t(spark, sf_dir, "events")
    return changes.changed(events, Table("events", "append_only", ("event_id",), _TS), back(_TS, max_cursor(events, _TS), timedelta(hours=2)), timedelta(0)).select("event_id")


@query("SELECT event_id, event_type FROM events WHERE (epoch_us(ts) + 500) // 1000 >= (SELECT max((epoch_us(ts) + 500) // 1000) - 86400000 FROM events)")
def mutable_native(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    return changes.changed(events, _MUTABLE, max_cursor(events, _TS), timedelta(days=1)).select("event_id", "event_type")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') OR l_linenumber > 3 GROUP BY ALL")
def follow_parent_late_child(spark, sf_dir):
    """Children of parents that have moved, and those that the target doesn't hold though their parents stand still."""
    child = Table("lineitem", "follow_parent", ("l_orderkey", "l_linenumber"), parent=Parent("orders", "l_orderkey", "o_orderkey"))
    parent = Table("orders", "mutable", ("o_orderkey",), Cursor("o_orderdate", TIMESTAMP))
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    held = lines.where("l_linenumber <= 3")
    return changes.changed(lines, child, "1998-01-01 00:00:00.000", timedelta(0), parent=_t(spark, sf_dir, "orders"), parent_table=parent, known=held)


@query("SELECT n_nationkey, n_name FROM nation")
def snapshot_reread(spark, sf_dir):
    """A snapshot is read whole, whatever the mark, and replaces what the target holds."""
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    read = changes.changed(nation, Table("nation", "snapshot", ("n_nationkey",)), "any mark", timedelta(0))
    return upsert(nation.withColumn("n_name", F.lower("n_name")), read, ["n_nationkey"])


_TYPED = {
    "text_eq_number": (Filter("k", "eq", 10), "k = '10'"), "text_ne_number": (Filter("k", "ne", 10), "k <> '10' OR k IS NULL"),
    "text_lt_number": (Filter("k", "lt", 10), "k < '10'"), "text_lte_number": (Filter("k", "lte", 10), "k <= '10'"),
    "text_gt_number": (Filter("k", "gt", 10), "k > '10'"), "text_gte_number": (Filter("k", "gte", 10), "k >= '10'"),
    "text_in_numbers": (Filter("k", "in", [10, 20]), "k IN ('10', '20')"), "text_not_in_numbers": (Filter("k", "not_in", [10, 20]), "k NOT IN ('10', '20') OR k IS NULL"),
    "number_eq_text": (Filter("c_custkey", "eq", "10"), "c_custkey = 10"), "number_lt_word": (Filter("c_custkey", "lt", "abc"), "true"),
    "number_gt_word": (Filter("c_custkey", "gt", "abc"), "false"), "number_not_in_mixed": (Filter("c_custkey", "not_in", ["10", "abc", 12]), "c_custkey NOT IN (10, 12)"),
}


def _typed(spark, sf_dir, own):
    customers = _t(spark, sf_dir, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey AS STRING) END").alias("k"))
    return customers.where(compile_filters([own], customers.schema))


for _name, (_filter, _sql) in _TYPED.items():
    query(f"SELECT c_custkey, k FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS k FROM customer) WHERE {_sql}", f"filter_{_name}")(
        lambda spark, sf_dir, f=_filter: _typed(spark, sf_dir, f)
    )


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_valid(props)")
def json_of_target(spark, sf_dir):
    """A path into JSON as the target holds it."""
    return _split(spark, sf_dir)[0].where("props is not null").select("event_id", F.get_json_object("props", "$.k").alias("k")).unionByName(
        _t(spark, sf_dir, "events").where(f"{_POISONED} <> props").select("event_id", F.get_json_object(convert(F.col("props"), T.StringType(), "jsonb"), "$.k").alias("k")))


_LAYOUTS = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'", "yyyy-MM-dd HH:mm:ss.SSSSSS' +0000 UTC'", "yyyy-MM-dd HH:mm:ss.SSSSSS' +0000 UTC m=+0.5'", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'", "yyyy-MM-dd"]


@query("SELECT event_id, CASE WHEN event_id % 7 = 6 THEN epoch_us(date_trunc('day', ts)) ELSE epoch_us(ts) END AS at_micros FROM events")
def timestamp_layouts(spark, sf_dir):
    """Each of the layouts that sources write."""
    at = F.col("ts").cast("timestamp")
    text = F.coalesce(*(F.when(F.col("event_id") % 7 == i, F.date_format(at, layout)) for i, layout in enumerate(_LAYOUTS)))
    return _t(spark, sf_dir, "events").select("event_id", F.unix_micros(convert(text, T.StringType(), "timestamptz")).alias("at_micros"))


@query("SELECT p_partkey, p_name AS as_text, CAST(p_partkey AS BIGINT) AS as_bigint, CAST(p_partkey AS DOUBLE) AS as_double, CASE WHEN p_partkey % 2 = 0 THEN 'invalid input for type bigint: w' END AS refused FROM part")
def convert_scalars(spark, sf_dir):
    """Bytes as text, and text as whole and broken numbers; text that is no number is refused."""
    part = _t(spark, sf_dir, "part").select("p_partkey", F.encode("p_name", "UTF-8").alias("b"), F.col("p_partkey").cast("string").alias("n"))
    part = part.withColumn("w", F.when(F.col("p_partkey") % 2 == 0, F.lit("word")).otherwise(F.col("n")))
    return part.select(
        "p_partkey", convert(F.col("b"), T.BinaryType(), "text").alias("as_text"), convert(F.col("n"), T.StringType(), "bigint").alias("as_bigint"),
        convert(F.col("n"), T.StringType(), "double precision").alias("as_double"), refusal(F.col("w"), T.StringType(), "bigint", "w").alias("refused"),
    )


@query("SELECT event_id, 'prod-' || CAST(event_id AS VARCHAR) AS label, epoch_us(TIMESTAMP '2026-01-02 03:04:05') AS at_micros FROM events")
def enrich_env_and_now(spark, sf_dir):
    df, now, env = _t(spark, sf_dir, "events"), datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC), {"SITE": "prod"}
    label, at = (Extra(x).column(df.schema, "events", "laptop", now, env) for x in ("${env:SITE}-${row.event_id}", "${now}"))
    return df.select("event_id", label.alias("label"), F.unix_micros(at).alias("at_micros"))


_CONFIG = """
source: {path: /s.db, instance: here}
target: {path: /t}
defaults:
  since: 2026-01-01
  exclude_columns: [output]
  extra_fields: {site: "${source.instance}"}
tables:
  agents: {enabled: false}
  tasks: {filters: [{column: state, op: ne, value: x}]}
"""


@query("SELECT * FROM (VALUES ('tasks', 2, 'output', 'site'), ('task_logs', 1, 'output', 'site'), ('pr_event_watermarks', 0, 'output', 'site')) AS t(table_name, n_filters, excluded, extras)")
def config_resolution(spark, sf_dir):
    """Defaults, windows and a table's own settings, of three tables of the default catalog."""
    plan = resolve(configs.parse(_CONFIG), catalogs.load()).restrict(["tasks", "task_logs", "pr_event_watermarks"])
    return spark.createDataFrame([(t.name, len(t.filters), ",".join(sorted(t.exclude)), ",".join(t.extras)) for t in plan.tables], "table_name string, n_filters int, excluded string, extras string")


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(s_suppkey) AS BIGINT) AS keys, min(s_name) AS first_name, CAST(round(sum(s_acctbal) * 100) AS BIGINT) AS cents FROM supplier")
def sqlite_scan(spark, sf_dir):
    """Suppliers written to a SQLite file and read through the source, in ranges of rowids."""
    path = _sqlite(spark, sf_dir)
    found = SqliteSource(spark, path, 4).read("supplier", ["s_suppkey", "s_name", "s_acctbal"])
    return found.agg(F.count("*").alias("n"), F.sum("s_suppkey").alias("keys"), F.min("s_name").alias("first_name"), F.round(F.sum("s_acctbal") * 100).cast("bigint").alias("cents"))


@query("SELECT 'supplier' AS table_name, 's_suppkey' AS key, count(*) AS n FROM supplier")
def sqlite_reflect_and_count(spark, sf_dir):
    source = SqliteSource(spark, _sqlite(spark, sf_dir), 4)
    return spark.createDataFrame([(t.name, ",".join(t.key), source.count(t.name)) for t in source.reflect().values()], "table_name string, key string, n long")


def _sqlite(spark, sf_dir) -> str:
    """A SQLite file of the suppliers (10,000 x sf, so the driver can write them) where executors can open it."""
    folder = (spark.conf.get("spark.checkpoint.dir", None) or "/tmp/tidemark-checkpoints").removeprefix("file://").rstrip("/")
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = f"{folder}/supplier-{uuid.uuid4().hex}.db"
    rows = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_acctbal").cast("double")).toLocalIterator()
    with closing(sqlite3.connect(path)) as db:
        db.execute("CREATE TABLE supplier (s_suppkey INTEGER PRIMARY KEY, s_name TEXT, s_acctbal REAL)")
        db.executemany("INSERT INTO supplier VALUES (?, ?, ?)", map(tuple, rows))
        db.commit()
    return path


@query("SELECT CAST(count(*) AS BIGINT) AS rows_total, 2 AS passes, CAST(max(o_orderkey) AS VARCHAR) AS mark FROM orders")
def loop_passes(spark, sf_dir):
    """Two passes of the loop over orders that don't change: the metrics, and the mark that is left."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    table = Table("orders", "append_only", ("o_orderkey",), Cursor("o_orderkey", INTEGER))
    store = _temporary_store(spark)
    runner = Runner(spark, FrameSource({"orders": orders}, {"orders": ["o_orderkey"]}), store, Plan([TablePlan(table)]), Catalog({"orders": table}), "a", env={})
    runner.migrate()
    metrics = Metrics("a")

    def passed(done):
        metrics.passed(done)
        if metrics.passes == 2:
            loop.end()

    loop = Loop(runner.sync, interval=0.0, on_pass=passed)
    loop.go()
    return spark.createDataFrame([(store.marks("a")["orders"].rows_total, metrics.passes, store.marks("a")["orders"].value)], "rows_total long, passes int, mark string")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_orderkey LIMIT 100")
def open_keys_limit(spark, sf_dir):
    """The least of the keys that a target holds unsettled."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    store = _temporary_store(spark)
    runner = Runner(spark, FrameSource({"orders": orders}, {"orders": ["o_orderkey"]}), store, Plan([TablePlan(_OPEN)]), Catalog({"orders": _OPEN}), "a", env={})
    runner.migrate()
    if error := runner.backfill().error:
        raise error
    return store.open_keys("orders", "a", "o_orderkey", "o_orderstatus", ("F",), 100)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders backfilled and followed into a target, then the cost report over it."""
    held = backfill_then_sync(spark, sf_dir).join(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    latest = held.agg(F.max("o_orderdate")).first()[0]
    executions = held.select(
        F.col("o_custkey").cast("string").alias("agent_id"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"),
        F.col("o_orderdate").alias("created_at"), F.col("o_totalprice").alias("cost_usd"), F.col("o_orderkey").alias("total_tokens"),
    )
    return reports.cost_by_agent(executions, latest, days=3650)
