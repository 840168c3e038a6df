"""Weakly declared source types to the eight target types, and those to Spark's."""

from __future__ import annotations

import re

from pyspark.sql import types as T

#: The target type names and their Spark types. Numbers of unbounded precision get 38 digits, 18 after the point.
SPARK_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "bigint": T.LongType(),
    "double precision": T.DoubleType(),
    "numeric": T.DecimalType(38, 18),
    "boolean": T.BooleanType(),
    "timestamptz": T.TimestampType(),
    "jsonb": T.StringType(),
    "bytea": T.BinaryType(),
}


def parse_type(name: str) -> str:
    """A target type as a configuration spells it, in any case."""
    found = " ".join(name.lower().split())
    if found not in SPARK_TYPES:
        raise ValueError(f"unknown type {name!r}; one of {', '.join(sorted(SPARK_TYPES))}")
    return found


def affinity(declared: str) -> str:
    """The target type of a declared source type; only its first token counts, and tests go in this order."""
    token = re.split(r"[ (]", declared.strip().upper(), maxsplit=1)[0]
    if not token:
        return "bytea"
    if token in ("BOOLEAN", "BOOL"):
        return "boolean"
    if "TIMESTAMP" in token or token in ("DATETIME", "DATE"):
        return "timestamptz"
    for marks, kind in ((("INT",), "bigint"), (("CHAR", "CLOB", "TEXT"), "text"), (("BLOB",), "bytea"), (("REAL", "FLOA", "DOUB"), "double precision")):
        if any(m in token for m in marks):
            return kind
    return "numeric"


def map_column(name: str, declared: str, json_columns=()) -> str:
    """JSON is declared by name, never guessed; otherwise the affinity decides."""
    return "jsonb" if name in json_columns else affinity(declared)


def spark_type(name: str) -> T.DataType:
    return SPARK_TYPES[parse_type(name)]


def target_type(kind: T.DataType) -> str:
    """Back from a Spark type; narrower numbers widen, anything unknown is text."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "double precision"
    if isinstance(kind, T.DecimalType):
        return "numeric"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "timestamptz"
    return "bytea" if isinstance(kind, T.BinaryType) else "text"
