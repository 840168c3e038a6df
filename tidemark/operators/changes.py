"""Which rows of a table a pass reads: one predicate or semi-join for each class, so one scan and no duplicates."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cursor import advance, back, open_rows
from ..plans.catalog import APPEND_ONLY, FOLLOW_PARENT, MUTABLE, OPEN_ROW, Parent, Table


def _kind(df: DataFrame, table: Table):
    """The type of a table's cursor."""
    return df.schema[table.cursor.column].dataType


def append_only(df: DataFrame, table: Table, mark: str) -> DataFrame:
    return df.where(advance(table.cursor, mark, kind=_kind(df, table)))


def mutable(df: DataFrame, table: Table, mark: str, overlap: timedelta) -> DataFrame:
    return df.where(advance(table.cursor, back(table.cursor, mark, overlap), inclusive=True, kind=_kind(df, table)))


def open_row(df: DataFrame, table: Table, mark: str, open_keys: DataFrame | None, source_side: bool = False) -> DataFrame:
    """Rows past the mark, and those whose key the target holds unsettled; source_side: and all that are unsettled here.

    The keys are joined, however many; Spark broadcasts them only where they are known to be few.
    """
    if not mark:
        return df
    moved = advance(table.cursor, mark, kind=_kind(df, table))
    if source_side and table.state:
        moved = moved | open_rows(table.state.column, table.state.terminal)
    moved = F.coalesce(moved, F.lit(False))
    if open_keys is None:
        return df.where(moved)
    (key,) = table.key
    keys = open_keys.select(F.col(key).alias("_open")).where("_open is not null").distinct().withColumn("_found", F.lit(True))
    # one join and one filter: a row that is past the mark and unsettled comes once
    return df.join(keys, df[key] == keys["_open"], "left").where(moved | F.col("_found")).drop("_open", "_found")


def follow_parent(df: DataFrame, parent: DataFrame | None, link: Parent, parent_table: Table | None, mark: str, overlap: timedelta = timedelta(0), key: tuple[str, ...] = (), known: DataFrame | None = None) -> DataFrame:
    """Rows whose parent has moved since the parent's mark, and those whose key the target doesn't hold; everything where that can't be told.

    known: the keys that the target holds, under the key's names. A row that comes after its parent has moved last is found by
    it. Without known, such rows are found only within the overlap. Where a parent's rows never change, neither of both sees a changed child:
    a parent of class append_only means everything.
    """
    if not mark or parent is None or parent_table is None or parent_table.cursor is None or parent_table.follow == APPEND_ONLY:
        return df
    moved = parent.where(advance(parent_table.cursor, back(parent_table.cursor, mark, overlap), inclusive=True, kind=_kind(parent, parent_table))).select(F.col(link.remote).alias("_parent"))
    if known is None or not key:
        return df.join(moved, df[link.local] == F.col("_parent"), "left_semi")
    held = known.select(*(F.col(f"`{k}`").cast("string").alias(f"_known_{i}") for i, k in enumerate(key))).withColumn("_held", F.lit(True))
    marked = df.join(moved.distinct().withColumn("_moved", F.lit(True)), df[link.local] == F.col("_parent"), "left")
    # keys are compared as text; one that reads otherwise in the target only makes its row come again
    marked = marked.join(held, [df[k].cast("string") == F.col(f"_known_{i}") for i, k in enumerate(key)], "left")
    return marked.where("_moved or _held is null").select(*(df[c] for c in df.columns))


def changed(df: DataFrame, table: Table, mark: str, overlap: timedelta, open_keys: DataFrame | None = None, parent: DataFrame | None = None, parent_table: Table | None = None, source_side: bool = False, known: DataFrame | None = None) -> DataFrame:
    """The rows of a filtered table that a pass reads; without a mark every class reads everything. known: the keys that the target holds."""
    if not mark:
        return df
    if table.follow == APPEND_ONLY:
        return append_only(df, table, mark)
    if table.follow == MUTABLE:
        return mutable(df, table, mark, overlap)
    if table.follow == OPEN_ROW:
        return open_row(df, table, mark, open_keys, source_side)
    if table.follow == FOLLOW_PARENT:
        return follow_parent(df, parent, table.parent, parent_table, mark, overlap, table.key, known)
    return df
