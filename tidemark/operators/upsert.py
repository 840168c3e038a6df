"""Keyed upsert on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_writer(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Of the rows of a key the one that is last in a total order."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*(c.desc() for c in order)))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def upsert(target: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """The target with the incoming rows in place of those of the same key: every other column is overwritten, nulls too.

    incoming has a row for each key. Where all columns are keys, rows that are there already stay as they are. Columns that
    only one side has are null in the other's rows.
    """
    if set(target.columns) <= set(key) and set(incoming.columns) <= set(key):
        return target.unionByName(incoming.join(target, key, "left_anti"))
    return target.join(incoming.select(*key), key, "left_anti").unionByName(incoming, allowMissingColumns=True).select(*dict.fromkeys([*target.columns, *incoming.columns]))
