"""Values of weakly typed sources as target types, and why a value can't be held."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import spark_type


def to_boolean(c: Column, kind: T.DataType) -> Column:
    """Numbers: not 0. Other types pass only as they are."""
    if isinstance(kind, T.BooleanType):
        return c
    if isinstance(kind, T.NumericType):
        return c != 0
    return F.when(F.lower(c.cast("string")).isin("t", "true"), True).when(F.lower(c.cast("string")).isin("f", "false"), False)


def to_timestamp(c: Column, kind: T.DataType) -> Column:
    """Any of the layouts that sources write; a monotonic clock's trace and a zone's name are cut. Unreadable text is null."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    text = F.regexp_replace(F.trim(c.cast("string")), r" m=[+=-].*$", "")
    text = F.regexp_replace(text, r" ?([+-][0-9]{2}):?([0-9]{2})( [A-Z]{2,5})?$", "$1:$2")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def to_json(c: Column) -> Column:
    """JSON text as it is; blank text is null."""
    text = c.cast("string")
    return F.when(F.trim(text) != "", text)


def valid_json(c: Column) -> Column:
    """Null, or text that the JSON parser takes as a whole."""
    return c.isNull() | F.try_parse_json(c).isNotNull()


def to_text(c: Column, kind: T.DataType) -> Column:
    return F.decode(c, "UTF-8") if isinstance(kind, T.BinaryType) else c.cast("string")


def convert(c: Column, kind: T.DataType, target: str) -> Column:
    """The value as the target type; null where it can't be."""
    if target == "boolean":
        return to_boolean(c, kind)
    if target == "timestamptz":
        return to_timestamp(c, kind)
    if target == "jsonb":
        return to_json(to_text(c, kind))
    if target == "text":
        return to_text(c, kind)
    if target == "bytea":
        return c.cast("string").cast("binary") if not isinstance(kind, T.BinaryType) else c
    if isinstance(kind, T.BinaryType):
        c = F.decode(c, "UTF-8")
    return c.try_cast(spark_type(target))


def refusal(c: Column, kind: T.DataType, target: str, name: str) -> Column:
    """Why the target can't hold a value; null if it can. Unreadable timestamps aren't refused: they become null."""
    if target == "jsonb":
        return F.when(~valid_json(convert(c, kind, target)), F.lit(f"invalid input for type json: {name}"))
    if target in ("boolean", "bigint", "double precision", "numeric"):
        return F.when(c.isNotNull() & convert(c, kind, target).isNull(), F.lit(f"invalid input for type {target}: {name}"))
    return F.lit(None).cast("string")
