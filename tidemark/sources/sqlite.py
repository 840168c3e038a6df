"""SQLite files as a Spark data source: read-only, in parallel rowid ranges, only the wanted columns.

Columns are read in their declared class: integers and booleans as bigint, reals as double, blobs as binary,
everything else as text. A value of another class is null, and the row's ``_refused`` says so. ``_order`` is the
rowid, or the place in key order for tables without one. Executors open the file by its path, so it must be on a shared file system.
"""

from __future__ import annotations

import sqlite3
from contextlib import closing
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..functions.types import affinity
from ..plans.schema import LiveTable

_KINDS = {"bigint": T.LongType(), "boolean": T.LongType(), "double precision": T.DoubleType(), "bytea": T.BinaryType()}
#: Classes of values that a column takes as they are, and its Arrow type; rows of a batch.
_CLASSES = {T.LongType: ({int, type(None)}, pa.int64()), T.DoubleType: ({float, type(None)}, pa.float64()), T.BinaryType: ({bytes, type(None)}, pa.binary()), T.StringType: ({str, type(None)}, pa.string())}
BATCH = 8192
_COMPARE = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def open_readonly(path: str, busy_ms: int = 5000) -> sqlite3.Connection:
    """Never creates the file, never writes."""
    db = sqlite3.connect(f"file:{quote(str(Path(path).resolve()))}?mode=ro", uri=True, timeout=busy_ms / 1000)
    db.execute("PRAGMA query_only = 1")
    return db


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def list_tables(path: str) -> list[str]:
    with closing(open_readonly(path)) as db:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite\\_%' ESCAPE '\\' ORDER BY name")]


def reflect(path: str) -> dict[str, LiveTable]:
    out = {}
    with closing(open_readonly(path)) as db:
        for name in list_tables(path):
            info = db.execute(f"PRAGMA table_info({quoted(name)})").fetchall()
            out[name] = LiveTable(name, [(r[1], r[2] or "") for r in info], [r[1] for r in sorted((r for r in info if r[5]), key=lambda r: r[5])])
    return out


def _struct(table: LiveTable, columns: list[str]) -> T.StructType:
    declared = dict(table.columns)
    fields = [T.StructField(c, _KINDS.get(affinity(declared[c]), T.StringType()), True, {"declared": declared[c]}) for c in columns]
    return T.StructType([*fields, T.StructField("_order", T.LongType()), T.StructField("_refused", T.StringType())])


class _Range(InputPartition):
    def __init__(self, low: int | None, high: int | None):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.parts = int(options.get("partitions", "8"))
        self.names = [f.name for f in schema if f.name not in ("_order", "_refused")]
        self.tests: list[tuple[str, object]] = []
        self.floor = (options["floor_column"], options["floor"]) if options.get("floor") and options.get("floor_column") else None

    def partitions(self):
        with closing(open_readonly(self.path)) as db:
            try:
                low, high = db.execute(f"SELECT MIN(rowid), MAX(rowid) FROM {quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:  # a table without rowids is read in one go
                return [_Range(None, None)]
        if low is None:
            return [_Range(0, -1)]  # an empty table: Spark wants a partition
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Range(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, part: _Range):
        """Arrow batches."""
        wanted = ", ".join(map(quoted, self.names)) or "1"
        tests, values = [t for t, _ in self.tests], [v for _, v in self.tests]
        if self.floor:
            own = f"strftime('%Y-%m-%d %H:%M:%f', {quoted(self.floor[0])})"
            tests, values = [*tests, f"({own} >= ? OR {own} IS NULL)"], [*values, self.floor[1]]
        if part.low is not None:
            tests, values = [*tests, "rowid BETWEEN ? AND ?"], [*values, part.low, part.high]
        place = "rowid" if part.low is not None else "0"
        where = f" WHERE {' AND '.join(tests)}" if tests else ""
        kinds = [self.schema[c].dataType for c in self.names]
        with closing(open_readonly(self.path)) as db:
            db.text_factory = lambda raw: raw.decode("utf-8", "replace")
            rows, seen = db.execute(f"SELECT {place}, {wanted} FROM {quoted(self.table)}{where}", values), 0
            while some := rows.fetchmany(BATCH):
                order, *columns = zip(*some, strict=True)
                refused: list[str | None] = [None] * len(some)
                arrays = [_column(name, kind, column, refused) for name, kind, column in zip(self.names, kinds, columns, strict=False)]
                order = order if part.low is not None else range(seen, seen + len(some))
                seen += len(some)
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(order, pa.int64()), pa.array(refused, pa.string())], names=[*self.names, "_order", "_refused"])


class PushingReader(SqliteReader):
    def pushFilters(self, filters):
        """Comparisons of integers go to SQLite; Spark checks every filter again."""
        for f in filters:
            if type(f) in _COMPARE and len(f.attribute) == 1 and f.attribute[0] in self.names and isinstance(f.value, int) and isinstance(self.schema[f.attribute[0]].dataType, T.LongType):
                self.tests.append((f"{quoted(f.attribute[0])} {_COMPARE[type(f)]} ?", f.value))
            yield f


def _column(name: str, kind: T.DataType, values: tuple, refused: list[str | None]) -> pa.Array:
    """A column's values; a row with one of another class gets the reason in refused, if it has none yet."""
    own, arrow = _CLASSES[type(kind)]
    if set(map(type, values)) <= own:
        return pa.array(values, arrow)
    out = []
    for i, value in enumerate(values):
        held, ok = _held(value, kind)
        out.append(held)
        if not ok:
            refused[i] = refused[i] or f"invalid input for column {name}: {value!r:.200}"
    return pa.array(out, arrow)


def _held(value, kind: T.DataType) -> tuple[object, bool]:
    if value is None:
        return None, True
    if isinstance(kind, T.StringType):
        return (value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)), True
    if isinstance(kind, T.BinaryType):
        return (value if isinstance(value, bytes) else str(value).encode()), True
    if isinstance(kind, T.LongType):
        return (value, True) if isinstance(value, int) else (int(value), True) if isinstance(value, float) and value.is_integer() else (None, False)
    return (float(value), True) if isinstance(value, (int, float)) else (None, False)


class SqliteDataSource(DataSource):
    """format("tidemark_sqlite") with options path, table, columns (comma-separated), partitions, pushdown.

    pushdown: true where the session has it on; Spark refuses readers that push filters where it is off, and it is off by default.
    floor_column, floor: rows whose timestamp text lies before the UTC text floor needn't be read; unreadable ones are.
    """

    @classmethod
    def name(cls) -> str:
        return "tidemark_sqlite"

    def schema(self) -> T.StructType:
        table = reflect(self.options["path"])[self.options["table"]]
        wanted = [c for c in self.options.get("columns", "").split(",") if c]
        return _struct(table, [c for c in table.names if not wanted or c in wanted])

    def reader(self, schema: T.StructType) -> SqliteReader:
        return (PushingReader if self.options.get("pushdown", "").lower() == "true" else SqliteReader)(dict(self.options), schema)


class SqliteSource:
    """A SQLite file as the pipeline reads it."""

    def __init__(self, spark: SparkSession, path: str, partitions: int = 8):
        self.spark, self.path, self.parts = spark, path, partitions
        spark.dataSource.register(SqliteDataSource)

    def reflect(self) -> dict[str, LiveTable]:
        return reflect(self.path)

    def read(self, table: str, columns: list[str], floor: tuple[str, str] | None = None) -> DataFrame:
        """floor: a column and a UTC text before which its rows needn't be read."""
        if not columns:
            raise ValueError(f"{table}: no columns to read")
        reader = self.spark.read.format("tidemark_sqlite").option("path", self.path).option("table", table).option("columns", ",".join(columns)).option("partitions", self.parts)
        reader = reader.option("pushdown", self.spark.conf.get("spark.sql.python.filterPushdown.enabled"))
        return (reader.option("floor_column", floor[0]).option("floor", floor[1]) if floor else reader).load()

    def count(self, table: str) -> int:
        with closing(open_readonly(self.path)) as db:
            return db.execute(f"SELECT COUNT(*) FROM {quoted(table)}").fetchone()[0]
