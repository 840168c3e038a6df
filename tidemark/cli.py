"""Commands: doctor, migrate, backfill, sync."""

from __future__ import annotations

import argparse
import signal
import sys
import time

from pyspark.sql import SparkSession

from .operators.store import TargetStore
from .pipeline import Runner
from .plans import catalog as catalogs
from .plans import config as configs
from .plans.resolve import resolve
from .plans.schema import drift
from .sources.sqlite import SqliteSource, reflect
from .streaming.loop import Loop
from .streaming.metrics import Metrics, serve
from .streaming.wake import follow


def _session() -> SparkSession:
    return SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").config("spark.sql.python.filterPushdown.enabled", "true").getOrCreate()


def _runner(args) -> tuple[Runner, configs.Config]:
    config, catalog = configs.load(args.config), catalogs.load(args.catalog) if args.catalog else catalogs.load()
    plan = resolve(config, catalog).restrict([t for t in (args.tables or "").split(",") if t])
    spark = _session()
    source = SqliteSource(spark, config.source.path)
    if problems := plan.check({n: t.names for n, t in source.reflect().items()}):
        raise ValueError("; ".join(problems))
    return Runner(spark, source, TargetStore(spark, f"{config.target.path}/{config.target.schema}"), plan, catalog, config.source.instance, configs.duration(config.overlap)), config


def doctor(args) -> int:
    catalog = catalogs.load(args.catalog) if args.catalog else catalogs.load()
    problems: list[str] = []
    notes: list[str] = []
    path = args.source
    if args.config:
        try:
            config = configs.load(args.config)
            path = path or config.source.path
            plan = resolve(config, catalog)
            live = reflect(path)
            problems = plan.check({n: t.names for n, t in live.items()})
            if skipped := plan.absent(live):
                notes.append(f"config: not in this source and skipped: {', '.join(skipped)}")
            if plan.unwindowed:
                notes.append(f"config: no time column, so replicated in full: {', '.join(plan.unwindowed)}")
        except ValueError as e:
            problems = [str(e)]
    if not path:
        raise ValueError("doctor needs --source or a configuration with one")
    findings = drift(catalog, reflect(path))
    print("\n".join([*map(str, findings), *(f"config: {p}" for p in problems), *notes] or ["no findings"]))
    return int(bool(problems) or any(f.level == "error" for f in findings))


def migrate(args) -> int:
    runner, _ = _runner(args)
    found = runner.changes()
    for c in found:
        print(c.sql or f"-- blocked: {c.table}: {c.reason}")
    if any(c.kind == "blocked" for c in found):
        return 1
    if not args.dry_run:
        runner.migrate()
    return 0


def _pending(runner: Runner, allowed: bool) -> None:
    if found := runner.changes():
        blocked = [f"{c.table}: {c.reason}" for c in found if c.kind == "blocked"]
        if not allowed or blocked:
            raise ValueError("; ".join([f"the target needs {len(found)} change(s); run migrate first", *(f"blocked: {b}" for b in blocked)]))
        runner.migrate()


def backfill(args) -> int:
    runner, _ = _runner(args)
    _pending(runner, args.migrate)
    done = runner.backfill()
    for t in done.tables:
        print(f"{t.table}: {t.rows} rows, {t.quarantined} set aside, {t.seconds:.1f} s")
    if done.error:
        raise done.error
    for name in runner.plan.absent(runner.source.reflect()):
        print(f"{name}: skipped, not in this source")
    return 0


def sync(args) -> int:
    runner, config = _runner(args)
    _pending(runner, False)
    metrics, began = Metrics(config.source.instance), [time.monotonic()]

    def one():
        began[0] = time.monotonic()
        return runner.sync()

    def failed(e):
        metrics.failed(e)
        print(f"pass failed: {e}", file=sys.stderr)
        return True

    def passed(p):
        metrics.passed(p, time.monotonic() - began[0], runner.lags())
        runner.store.vacuum()
        if args.verbose:
            for t in p.tables:
                print(f"{t.table}: {t.rows} rows, {t.quarantined} set aside, {t.seconds:.1f} s", flush=True)

    loop = Loop(one, configs.duration(config.interval).total_seconds(), once=args.once, on_pass=passed, on_error=failed)
    if args.metrics:
        host, _, port = args.metrics.rpartition(":")
        serve(metrics, host or "127.0.0.1", int(port))
    if config.source.wake:
        follow(config.source.wake, loop.wake.set, loop.stop)
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: loop.end())
    loop.go()
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    commands = parser.add_subparsers(required=True)
    for work in (doctor, migrate, backfill, sync):
        own = commands.add_parser(work.__name__)
        own.set_defaults(work=work)
        own.add_argument("-c", "--config", required=work is not doctor)
        own.add_argument("--catalog")
        if work is doctor:
            own.add_argument("--source")
        else:
            own.add_argument("--tables")
        if work is migrate:
            own.add_argument("--dry-run", action="store_true")
        if work is backfill:
            own.add_argument("--migrate", action="store_true")
        if work is sync:
            own.add_argument("--once", action="store_true")
            own.add_argument("--metrics")
            own.add_argument("-v", "--verbose", action="store_true", help="say what each pass has done")
    args = parser.parse_args(argv)
    try:
        return args.work(args)
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
