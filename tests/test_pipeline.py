import sqlite3
from datetime import timedelta

import pytest

from tidemark import cli
from tidemark.functions.cursor import Cursor
from tidemark.functions.predicates import Filter
from tidemark.functions.templates import Extra
from tidemark.operators.store import TargetStore
from tidemark.pipeline import Runner
from tidemark.plans.catalog import Catalog, Parent, State, Table
from tidemark.plans.resolve import Plan, TablePlan
from tidemark.plans.schema import INSTANCE
from tidemark.sources.sqlite import SqliteSource, list_tables, reflect

TABLES = {
    "events": Table("events", "append_only", ("id",), Cursor("id", "integer"), json_columns=("meta",)),
    "runs": Table("runs", "open_row", ("id",), Cursor("id", "integer"), State("status", ("success", "failed"))),
    "flows": Table("flows", "mutable", ("id",), Cursor("updated_at", "timestamp")),
    "shots": Table("shots", "follow_parent", ("flow_id",), parent=Parent("flows", "flow_id", "id")),
    "marks": Table("marks", "snapshot", ("source",)),
}
DDL = """
CREATE TABLE events (id INTEGER PRIMARY KEY, kind TEXT, meta TEXT, ok BOOLEAN, at TIMESTAMP);
CREATE TABLE runs (id INTEGER PRIMARY KEY, status TEXT, cost REAL, created_at TIMESTAMP);
CREATE TABLE flows (id TEXT PRIMARY KEY, updated_at TIMESTAMP);
CREATE TABLE shots (flow_id TEXT PRIMARY KEY, body TEXT);
CREATE TABLE marks (source TEXT PRIMARY KEY, value TEXT) WITHOUT ROWID;
"""


class World:
    def __init__(self, spark, folder):
        self.spark, self.path = spark, str(folder / "s.db")
        self.store = TargetStore(spark, str(folder / "target"), buckets=4)
        self.sql(DDL)

    def sql(self, text):
        with sqlite3.connect(self.path) as db:
            db.executescript(text)

    def runner(self, *names, instance="here", **more):
        plans = [TablePlan(TABLES[n], json_columns=list(TABLES[n].json_columns), **more.pop("plan", {})) for n in names]
        runner = Runner(self.spark, SqliteSource(self.spark, self.path, 2), self.store, Plan(plans), Catalog(TABLES), instance, timedelta(seconds=30), **more)
        runner.migrate()
        return runner

    def rows(self, name, *columns):
        return sorted(tuple(r) for r in self.store.read(name).select(*columns).collect())


def ran(done):
    if done.error:
        raise done.error
    return done


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def test_reflect(world):
    assert list_tables(world.path) == ["events", "flows", "marks", "runs", "shots"]
    assert reflect(world.path)["runs"].columns[2] == ("cost", "REAL") and reflect(world.path)["marks"].key == ["source"]
    with pytest.raises(sqlite3.OperationalError):
        list_tables(world.path + ".gone")


def test_append_only_conversion_and_poison(world):
    world.sql("INSERT INTO events VALUES (1,'a','{\"k\":1}',1,'2026-08-01 06:00:00 -0400 EDT m=+1'),(2,'b','this is definitely not json',0,NULL),(3,'c','',NULL,'odd')")
    runner = world.runner("events")
    done = ran(runner.sync())
    assert (done.rows, done.quarantined) == (3, 1)
    assert world.rows("events", "id", "meta", "ok") == [(1, '{"k":1}', True), (3, None, None)]
    assert [(r.row_key, r.table_name) for r in world.store.quarantined().collect()] == [("2", "events")]
    assert world.store.marks("here")["events"].value == "3"
    assert ran(runner.sync()).rows == 0
    world.sql("INSERT INTO events VALUES (4,'d',NULL,1,NULL)")
    assert ran(runner.sync()).rows == 1
    assert world.store.marks("here")["events"].rows_total == 4


def test_open_row_lifecycle(world):
    world.sql("INSERT INTO runs VALUES (1,'success',1,NULL),(2,'running',0,NULL),(3,NULL,0,NULL),(4,'failed',0,NULL)")
    runner = world.runner("runs")
    assert ran(runner.sync()).rows == 4
    world.sql("UPDATE runs SET status='success', cost=1.25 WHERE id=2")
    assert ran(runner.sync()).rows == 2  # the running one and the one without a state
    assert world.rows("runs", "id", "cost")[1] == (2, 1.25)
    assert ran(runner.sync()).rows == 1


def test_filtered_row_comes_when_it_settles(world):
    world.sql("INSERT INTO runs VALUES (1,'running',0,NULL)")
    runner = world.runner("runs", plan={"filters": [Filter("status", "eq", "success")]})
    assert ran(runner.sync()).rows == 0
    world.sql("UPDATE runs SET status='success', cost=1.5")
    ran(runner.sync())
    assert world.rows("runs", "id", "cost") == [(1, 1.5)]


def test_parent_and_snapshot(world):
    world.sql("INSERT INTO flows VALUES ('f','2026-01-01 00:00:00'),('g','2026-01-01 00:00:00'); INSERT INTO shots VALUES ('f','1'),('g','1'); INSERT INTO marks VALUES ('s','1')")
    runner = world.runner("flows", "shots", "marks")
    assert ran(runner.sync()).rows == 5
    world.sql("UPDATE flows SET updated_at='2026-01-02 00:00:00' WHERE id='f'; UPDATE shots SET body='2' WHERE flow_id='f'; UPDATE marks SET value='2'")
    ran(runner.sync())
    done = ran(runner.sync())
    assert world.rows("shots", "flow_id", "body") == [("f", "2"), ("g", "1")] and world.rows("marks", "value") == [("2",)]
    assert {t.table: t.rows for t in done.tables} == {"flows": 1, "shots": 1, "marks": 1}  # the overlap reads the last again
    assert runner.lags().keys() == {"flows"}


def test_child_of_a_parent_that_stands_still(world):
    """A child that comes long after its parent moved last, and one of a parent that never moves."""
    world.sql("INSERT INTO flows VALUES ('f','2026-01-01 00:00:00'),('g','2026-01-05 00:00:00'); INSERT INTO shots VALUES ('g','1')")
    runner = world.runner("flows", "shots")
    ran(runner.sync())
    world.sql("INSERT INTO shots VALUES ('f','late')")
    ran(runner.sync())
    assert world.rows("shots", "flow_id", "body") == [("f", "late"), ("g", "1")]


def test_default_catalog_reads_findings_after_their_run(spark, tmp_path):
    from tidemark.plans import catalog as catalogs

    world = World(spark, tmp_path)
    world.sql("CREATE TABLE improvement_runs (id TEXT PRIMARY KEY, created_at TIMESTAMP); CREATE TABLE improvement_findings (id TEXT PRIMARY KEY, run_id TEXT, rationale TEXT)")
    world.sql("INSERT INTO improvement_runs VALUES ('r','2026-01-01 00:00:00')")
    catalog = catalogs.load()
    plans = [TablePlan(catalog.tables[n], exclude={"patch", "baseline_metrics"}) for n in ("improvement_runs", "improvement_findings")]
    runner = Runner(spark, SqliteSource(spark, world.path, 2), world.store, Plan(plans), catalog, "here", timedelta(seconds=30))
    runner.migrate()
    ran(runner.sync())
    world.sql("INSERT INTO improvement_runs VALUES ('s','2026-02-01 00:00:00'); INSERT INTO improvement_findings VALUES ('x','r','why')")
    ran(runner.sync())
    world.sql("UPDATE improvement_findings SET rationale='changed'")
    ran(runner.sync())
    assert world.rows("improvement_findings", "id", "rationale") == [("x", "changed")]


def test_a_pass_reads_its_source_once(spark, tmp_path):
    from tidemark.sources.frames import FrameSource

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    base = spark.createDataFrame([(i, "x" if i % 3 else "no json") for i in range(30)], "id long, meta string")
    table = Table("events", "append_only", ("id",), Cursor("id", "integer"), json_columns=("meta",))
    store = TargetStore(spark, str(tmp_path / "t"), buckets=2)
    runner = Runner(spark, FrameSource({"events": base.mapInArrow(count, base.schema)}, {"events": ["id"]}), store, Plan([TablePlan(table, json_columns=["meta"])]), Catalog({"events": table}), "here")
    runner.migrate()
    done = ran(runner.sync())
    assert done.rows == 30 and done.quarantined == 30 and seen.value == 30
    assert store.marks("here")["events"].value == "29"


def test_marks_never_move_back(world):
    world.sql("INSERT INTO events VALUES (5,'a',NULL,1,NULL)")
    runner = world.runner("events")
    ran(runner.sync())
    world.sql("DELETE FROM events")
    ran(runner.sync())
    assert world.store.marks("here")["events"].value == "5"


def test_pushed_marks_leave_no_row_out(world):
    """SQLite leaves out only what lies well before the mark; zones, odd texts and nulls come as without it."""
    world.sql("INSERT INTO flows VALUES ('a','2026-01-01 00:00:00'),('b','2026-01-01 23:00:00-04:00'),('c','odd'),('d',NULL),('e','2026-01-02 06:00:00 -0400 EDT'),('f','2025-01-01 00:00:00')")
    source = SqliteSource(world.spark, world.path, 2)
    assert sorted(r.id for r in source.read("flows", ["id", "updated_at"], ("updated_at", "2026-01-02 00:00:00.000")).collect()) == ["b", "c", "d", "e"]
    runner = world.runner("flows")
    ran(runner.sync())
    world.sql("INSERT INTO flows VALUES ('g','2026-02-01 00:00:00'),('h','2020-01-01 00:00:00')")
    assert ran(runner.sync()).rows == 2  # the new one and the last one again
    assert world.rows("flows", "id")[-1] == ("g",)


def test_vacuum(world, monkeypatch):
    from tidemark.operators import store as stores

    monkeypatch.setattr(stores, "DELTAS", 1)
    world.sql("INSERT INTO runs VALUES (1,'running',0,NULL)")
    runner = world.runner("runs")
    for _ in range(4):
        ran(runner.sync())
    before = world.rows("runs", "id", "status")
    assert world.store.vacuum(keep=2) > 0
    assert world.rows("runs", "id", "status") == before and world.store.vacuum(keep=2) == 0
    ran(runner.sync())
    assert world.rows("runs", "id", "status") == before


def test_small_passes_write_their_own_rows(spark, tmp_path, monkeypatch):
    """Each pass adds files of its rows alone; crowded buckets are compacted, and get more when they have grown."""
    from pyspark.sql import functions as F

    from tidemark.operators import store as stores
    from tidemark.sources.frames import FrameSource

    monkeypatch.setattr(stores, "DELTAS", 3)
    monkeypatch.setattr(stores, "BUCKET_ROWS", 30)
    table = Table("t", "mutable", ("id",), Cursor("at", "timestamp"))
    store = TargetStore(spark, str(tmp_path / "t"), buckets=2)

    def source(n):
        base = spark.range(100).select("id", F.lit("old").alias("v"), F.lit("2026-01-01 00:00:00").alias("at"))
        moved = spark.range(n).select("id", F.concat(F.lit("new"), F.lit(n).cast("string")).alias("v"), F.concat(F.lit("2026-02-0"), F.lit(n).cast("string"), F.lit(" 00:00:00")).alias("at"))
        return FrameSource({"t": base.where(F.col("id") >= n).union(moved)}, {"t": ["id"]})

    files = []
    for n in range(6):
        runner = Runner(spark, source(n), store, Plan([TablePlan(table)]), Catalog({"t": table}), "here", timedelta(seconds=1))
        runner.migrate()
        done = ran(runner.sync())
        assert done.rows == (100 if n == 0 else n) or n == 1
        files.append(sum(len(f) for f in store.manifest().tables["t"]["files"].values()))
        got = {r.id: r.v for r in store.read("t").collect()}
        assert got == {i: f"new{n}" if i < n else "old" for i in range(100)}
    assert files[1] > files[0] and store.manifest().tables["t"]["buckets"] == 4
    assert store.read("t").count() == 100


def test_vacuum_of_quarantine(world):
    for i in range(3):
        world.sql(f"INSERT INTO events VALUES ({i},'a','no json',1,NULL)")
        ran(world.runner("events").sync())
    assert len(world.store.manifest().quarantine) == 3
    world.store.vacuum(keep=1, quarantine_files=2)
    assert len(world.store.manifest().quarantine) == 1 and world.store.quarantined().count() == 3


def test_replay_instances_and_deletes(world):
    world.sql("INSERT INTO runs VALUES (1,'success',1,NULL),(2,'success',2,NULL)")
    for _ in range(2):
        ran(world.runner("runs").backfill())
    ran(world.runner("runs", instance="there").backfill())
    world.sql("DELETE FROM runs WHERE id=1")
    ran(world.runner("runs").backfill())
    assert world.rows("runs", INSTANCE, "id") == [("here", 1), ("here", 2), ("there", 1), ("there", 2)]


def test_schema_grows_and_blocks(world):
    world.sql("INSERT INTO runs VALUES (1,'success',1,NULL)")
    ran(world.runner("runs").sync())
    world.sql("ALTER TABLE runs ADD COLUMN note TEXT; INSERT INTO runs VALUES (2,'success',1,NULL,'n')")
    runner = world.runner("runs", plan={"extras": {"site": Extra("${source.instance}/${row.id}")}})
    ran(runner.sync())
    assert world.rows("runs", "id", "note", "site") == [(1, None, None), (2, "n", "here/2")]
    world.sql("DROP TABLE runs; CREATE TABLE runs (id INTEGER PRIMARY KEY, status TEXT, cost TEXT, created_at TIMESTAMP)")
    with pytest.raises(ValueError, match="cost is double precision, not text"):
        world.runner("runs")


def test_wrong_class_is_set_aside(world):
    world.sql("INSERT INTO runs VALUES (1,'success','dear',NULL),(2,'success',2,NULL)")
    done = ran(world.runner("runs").sync())
    assert (done.rows, done.quarantined) == (2, 1) and world.rows("runs", "id") == [(2,)]


def test_a_second_writer_is_refused(world):
    world.runner("runs")
    before = world.store.manifest()
    with pytest.raises(RuntimeError):
        world.store._commit(before, world.store._number() - 1)


def test_commands(world, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "_session", lambda: world.spark)
    world.sql("INSERT INTO runs VALUES (1,'success',1,NULL)")
    (tmp_path / "catalog.yaml").write_text("tables: {runs: {follow: open_row, key: [id], cursor: {column: id, kind: integer}, state: {column: status, terminal: [success]}}}")
    (tmp_path / "c.yaml").write_text(f"source: {{path: {world.path}, instance: here}}\ntarget: {{path: {tmp_path / 'out'}}}\n")
    common = ["-c", str(tmp_path / "c.yaml"), "--catalog", str(tmp_path / "catalog.yaml")]
    assert cli.main(["doctor", *common]) == 0
    assert cli.main(["backfill", *common]) == 1  # the target isn't there yet
    assert cli.main(["migrate", *common, "--dry-run"]) == 0 and "CREATE TABLE" in capsys.readouterr().out
    assert not (tmp_path / "out").exists()
    assert cli.main(["backfill", *common, "--migrate"]) == 0
    assert cli.main(["sync", *common, "--once"]) == 0
    assert TargetStore(world.spark, str(tmp_path / "out" / "replica")).read("runs").count() == 1


@pytest.mark.parametrize("pushdown", ["false", "true"])
def test_sqlite_scan_whatever_the_session_says_of_pushdown(spark, world, pushdown):
    """Spark's default is off, where it refuses readers that push filters."""
    from pyspark.sql import functions as F

    from tidemark.queries import QUERIES

    world.sql("INSERT INTO runs VALUES (1,'a',1,NULL),(2,'b',0,NULL),(3,NULL,0,NULL)")
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", pushdown)
    try:
        assert QUERIES["sqlite_scan"](spark, "/root/testdata/sf0.001").first().n == spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").count()
        assert sorted(r.id for r in SqliteSource(spark, world.path, 2).read("runs", ["id", "status"]).where(F.col("id") >= 2).collect()) == [2, 3]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)
