"""The target: tables of Parquet files in buckets by key, with atomic commits of data, marks and quarantine together.

Files are immutable. A commit is a small manifest file with the next number, written aside and renamed, which names
each table's files by bucket; readers take the last one. A pass writes its own rows alone, as one more file of each bucket that
gets any; of a key's rows the one of the last commit counts. A bucket of more than ``DELTAS`` such files is compacted into one, and
a table whose buckets have grown beyond ``BUCKET_ROWS`` rows gets more of them then. One writer at a time; a second one's rename fails, and its files
stay unused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cursor import open_rows
from ..functions.types import target_type
from ..plans.schema import INSTANCE, Change, TargetSchema
from .upsert import last_writer

#: Files that a bucket has at most beside its first one; rows of a bucket.
DELTAS, BUCKET_ROWS = 8, 2_000_000
#: Of each row, the commit that it came with.
SEQ = "_seq"


@dataclass
class Mark:
    kind: str | None = None
    value: str = ""
    rows_total: int = 0
    updated_at: str = ""


@dataclass
class Manifest:
    tables: dict = field(default_factory=dict)  # name -> {"schema", "key", "types", "buckets", "files": {bucket: [path]}}
    marks: dict = field(default_factory=dict)  # instance -> table -> mark
    quarantine: list = field(default_factory=list)


QUARANTINE = T.StructType([*(T.StructField(n, T.StringType()) for n in ("instance", "table_name", "row_key", "error_message", "row_data")), T.StructField("quarantined_at", T.TimestampType())])


class TargetStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 32):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        jvm = spark.sparkContext._jvm
        self._path = lambda *x: jvm.org.apache.hadoop.fs.Path("/".join((self.root, *x)))
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    # commits

    def _number(self) -> int:
        folder = self._path("_commits")
        if not self._fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return max([0, *(int(n[:-5]) for n in names if n.endswith(".json"))])

    def manifest(self, number: int | None = None) -> Manifest:
        number = self._number() if number is None else number
        if not number:
            return Manifest()
        stream = self._fs.open(self._path("_commits", f"{number:012d}.json"))
        try:
            return Manifest(**json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _commit(self, manifest: Manifest, after: int) -> None:
        aside = self._path("_commits", f".{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        stream.write(bytearray(json.dumps(vars(manifest)).encode()))
        stream.close()
        place = self._path("_commits", f"{after + 1:012d}.json")
        if self._fs.exists(place) or not self._fs.rename(aside, place):
            self._fs.delete(aside, False)
            raise RuntimeError("another writer has committed meanwhile")

    # schema

    def exists(self) -> bool:
        return self._fs.exists(self._path("_commits"))

    def ensure(self) -> None:
        self._fs.mkdirs(self._path("_commits"))

    def reflect(self, table: str) -> dict[str, str]:
        """Column to target type; empty if there is no such table."""
        own = self.manifest().tables.get(table)
        return dict(own["types"]) if own else {}

    def apply(self, changes: list[Change], wanted: dict[str, TargetSchema]) -> None:
        """All of the changes in one commit, or none if one is blocked."""
        if blocked := [c.reason for c in changes if c.kind == "blocked"]:
            raise ValueError("; ".join(blocked))
        if not changes:
            return
        self.ensure()
        number, manifest = self._number(), self.manifest()
        for name in {c.table for c in changes}:
            old = manifest.tables.get(name, {"files": {}, "types": {}, "schema": T.StructType().jsonValue()})
            schema = wanted[name]
            kept = T.StructType.fromJson(old["schema"])
            for c in schema.struct().fields:
                if c.name not in kept.names:
                    kept = kept.add(T.StructField(c.name, c.dataType, True))
            manifest.tables[name] = {"files": old["files"], "buckets": old.get("buckets", self.buckets), "key": schema.key, "schema": kept.jsonValue(), "types": old["types"] | {c.name: c.type for c in schema.columns}}
        self._commit(manifest, number)

    # rows

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        own = self.manifest().tables[table]
        return self._read(own, buckets)

    def _read(self, own: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(own["schema"])
        return self._merged(own, buckets).select(*schema.names)

    def _merged(self, own: dict, buckets: list[int] | None = None) -> DataFrame:
        """The rows that count, with the commits that they came with."""
        schema = T.StructType.fromJson(own["schema"]).add(T.StructField(SEQ, T.LongType()))
        files = [f for b, f in own["files"].items() if buckets is None or int(b) in buckets]
        alone, several = [f[0] for f in files if len(f) == 1], [p for f in files if len(f) > 1 for p in f]
        parts = [self.spark.read.schema(schema).parquet(*alone)] if alone else []
        if several:
            parts.append(last_writer(self.spark.read.schema(schema).parquet(*several), own["key"], [F.col(SEQ)]))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def quarantined(self) -> DataFrame:
        files = self.manifest().quarantine
        return self.spark.read.schema(QUARANTINE).parquet(*files) if files else self.spark.createDataFrame([], QUARANTINE)

    def marks(self, instance: str) -> dict[str, Mark]:
        return {t: Mark(**m) for t, m in self.manifest().marks.get(instance, {}).items()}

    def open_keys(self, table: str, instance: str, key: str, state: str, terminal, limit: int | None = None) -> DataFrame:
        """Keys of an instance's rows that aren't settled; with a limit, the least ones."""
        rows = self.read(table).where((F.col(INSTANCE) == instance) & open_rows(state, terminal)).select(key)
        return rows.orderBy(key).limit(limit) if limit else rows

    def keys(self, table: str, instance: str, key) -> DataFrame:
        """The keys of an instance's rows, one row for each."""
        return self.read(table).where(F.col(INSTANCE) == instance).select(*key)

    def stage(self, rows: DataFrame) -> tuple[DataFrame, str]:
        """The rows as they were when they were read, once, and where they are kept until ``drop``."""
        place = f"{self.root}/_stage/{uuid.uuid4().hex}"
        rows.write.parquet(place)
        return self.spark.read.schema(rows.schema).parquet(place), place

    def drop(self, place: str) -> None:
        self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(place), True)

    def write(self, table: str, good: DataFrame, bad: DataFrame | None, instance: str, mark: Mark | None, order: list[Column]) -> tuple[int, int]:
        """Upsert, quarantine and mark in one commit; numbers of rows written and set aside.

        good: a row or several for each key, of which the last in order is taken.
        """
        number, manifest = self._number(), self.manifest()
        own, run = manifest.tables[table], uuid.uuid4().hex
        schema = T.StructType.fromJson(own["schema"])
        # every column of the table: what the source lacks is null from now on
        rows = last_writer(good, own["key"], order).select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in good.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema), F.lit(number + 1).cast("long").alias(SEQ))
        sizes = self._put(own, f"{self.root}/{table}/{run}", rows, own["buckets"])
        self._compact(own, f"{self.root}/{table}/{run}-compacted")
        refused = 0
        if bad is not None:
            place = f"{self.root}/_quarantine/{run}"
            bad.withColumn("quarantined_at", F.lit(datetime.now(UTC)).cast("timestamp")).write.parquet(place)
            if refused := self.spark.read.schema(QUARANTINE).parquet(place).count():
                manifest.quarantine.append(place)
        if mark is not None:
            old = manifest.marks.setdefault(instance, {}).get(table, {})
            mark.rows_total += old.get("rows_total", 0)
            mark.updated_at = datetime.now(UTC).isoformat()
            manifest.marks[instance][table] = vars(mark)
        self._commit(manifest, number)
        return sum(sizes.values()), refused

    def _put(self, own: dict, place: str, rows: DataFrame, buckets: int, tasks: int | None = None) -> dict[int, int]:
        """Writes rows as one more file of each bucket that gets any; rows by bucket."""
        bucket = F.pmod(F.xxhash64(*(F.col(f"`{k}`").cast("string") for k in own["key"])), F.lit(buckets)).cast("int")
        placed = rows.withColumn("_bucket", bucket)
        (placed.repartition(tasks, "_bucket") if tasks else placed).write.partitionBy("_bucket").parquet(place)
        written = self.spark.read.schema(T.StructType([T.StructField("_bucket", T.IntegerType())])).parquet(place)
        sizes = {r[0]: r[1] for r in written.groupBy("_bucket").count().collect()}  # at most so many as there are buckets
        for b in sizes:
            own["files"].setdefault(str(b), []).append(f"{place}/_bucket={b}")
        return sizes

    def _compact(self, own: dict, place: str) -> None:
        """Makes one file of each bucket that has too many; of all, with more buckets, where these have grown too large."""
        crowded = [int(b) for b, files in own["files"].items() if len(files) > DELTAS + 1]
        if not crowded:
            return
        rows, wanted = self._merged(own).count(), own["buckets"]
        while rows > wanted * BUCKET_ROWS:
            wanted *= 2
        kept = own["files"] if wanted == own["buckets"] else {}
        merged = self._merged(own, crowded if kept else None)
        own["files"], own["buckets"] = {b: f for b, f in kept.items() if int(b) not in crowded}, wanted
        self._put(own, place, merged, wanted, len(crowded) if kept else wanted)

    def vacuum(self, keep: int = 20, quarantine_files: int = 64) -> int:
        """Deletes what only commits before the last keep ones name; how many files. Readers of older commits lose them.

        More than so many quarantine lists become one.
        """
        number, manifest = self._number(), self.manifest()
        if len(manifest.quarantine) > quarantine_files:
            place = f"{self.root}/_quarantine/{uuid.uuid4().hex}"
            self.quarantined().write.parquet(place)
            manifest.quarantine = [place]
            self._commit(manifest, number)
            number += 1
        folder = self._path("_commits")
        numbers = sorted(int(n[:-5]) for n in (f.getPath().getName() for f in self._fs.listStatus(folder)) if n.endswith(".json")) if self._fs.exists(folder) else []
        old, kept = numbers[:-keep], numbers[-keep:]
        if not old:
            return 0
        named = lambda n: {p for m in [self.manifest(n)] for p in (*m.quarantine, *(f for t in m.tables.values() for own in t["files"].values() for f in own))}
        gone = {p for n in old for p in named(n)} - {p for n in kept for p in named(n)}
        for path in sorted(gone):
            self.drop(path)
        for n in old:
            self._fs.delete(self._path("_commits", f"{n:012d}.json"), False)
        return len(gone)

    def types(self, table: str) -> dict[str, str]:
        return {f.name: target_type(f.dataType) for f in self.read(table).schema}
