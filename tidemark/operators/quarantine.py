"""Rows that the target can't hold are set aside with a reason, in the same pass as the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.convert import convert, refusal
from ..plans.schema import TargetSchema


def judged(df: DataFrame, schema: TargetSchema, source_columns: list[str]) -> DataFrame:
    """df with ``_reason``: why a row is refused, or null."""
    kinds = {c.name: c.type for c in schema.columns}
    reasons = [F.when(F.col(f"`{k}`").isNull(), F.lit(f"null value in key column {k}")) for k in schema.key if k in source_columns]
    reasons += [refusal(F.col(f"`{c}`"), df.schema[c].dataType, kinds[c], c) for c in source_columns]
    return df.withColumn("_reason", F.coalesce(*reasons, F.lit(None).cast("string")))


def split(df: DataFrame, schema: TargetSchema, source_columns: list[str], instance: str) -> tuple[DataFrame, DataFrame]:
    """(rows that are held, as the target types; rows that aren't: row_key, error_message, row_data of raw values)."""
    own = judged(df, schema, source_columns)
    kinds = {c.name: c.type for c in schema.columns}
    passed = [c for c in df.columns if c not in source_columns]
    good = own.where("_reason is null").select(*(convert(F.col(f"`{c}`"), df.schema[c].dataType, kinds[c]).alias(c) for c in source_columns), *(F.col(f"`{c}`") for c in passed))
    # of a composite key the last column in the columns' order names the row
    keys = [c for c in source_columns if c in schema.key]
    row_key = F.col(f"`{keys[-1]}`").cast("string") if keys else F.lit(None).cast("string")
    bad = own.where("_reason is not null").select(
        F.lit(instance).alias("instance"), F.lit(schema.table).alias("table_name"), row_key.alias("row_key"),
        F.col("_reason").alias("error_message"), F.to_json(F.struct(*(F.col(f"`{c}`") for c in source_columns)), {"ignoreNullFields": "false"}).alias("row_data"),
    )
    return good, bad
