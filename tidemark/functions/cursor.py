"""High-water marks: cursor text, advance, overlap, lag. Session time zone: UTC."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER, TIMESTAMP = "integer", "timestamp"
_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


@dataclass(frozen=True)
class Cursor:
    column: str
    kind: str


def parsed(c: Column) -> Column:
    """A timestamp from text that begins with a date; anything else is null, never an error."""
    text = c.cast("string")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def cursor_value(cursor: Cursor) -> Column:
    """What marks compare: the integer itself, or UTC text rounded to milliseconds."""
    c = F.col(f"`{cursor.column}`")
    if cursor.kind == INTEGER:
        return c.cast("bigint")
    return F.date_format(parsed(c) + F.expr("INTERVAL '0.0005' SECOND"), _FORMAT)


def _mark(cursor: Cursor, mark: str) -> Column:
    return F.lit(int(mark)) if cursor.kind == INTEGER else F.lit(mark)


def parsed_mark(mark: str) -> datetime | None:
    """A timestamp mark's time (UTC, without zone); None: it isn't one."""
    try:
        return datetime.strptime(mark, "%Y-%m-%d %H:%M:%S.%f")
    except ValueError:
        return None


def max_cursor(df: DataFrame, cursor: Cursor) -> str:
    """The greatest value, as text; "" without any."""
    value = df.agg(F.max(cursor_value(cursor))).first()[0]
    return "" if value is None else str(value)


def later(cursor: Cursor, a: str, b: str) -> str:
    """The greater of two marks; "" is less than any."""
    if not a or not b:
        return a or b
    return max(a, b, key=int) if cursor.kind == INTEGER else max(a, b)


def advance(cursor: Cursor, mark: str, inclusive: bool = False, kind: T.DataType | None = None) -> Column:
    """Rows past the mark (or on it); everything without a mark; rows without a readable cursor never, once there is one.

    kind: the column's type. Native timestamps are compared as they are, which files are pruned by: what rounds to more than
    the mark lies half a millisecond or more beyond it.
    """
    if not mark:
        return F.lit(True)
    at = parsed_mark(mark) if cursor.kind == TIMESTAMP and isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else None
    if at is not None:
        edge = at + timedelta(microseconds=-500 if inclusive else 500)
        return F.col(f"`{cursor.column}`") >= F.lit(edge.isoformat(sep=" ")).cast(kind)
    value, mark = cursor_value(cursor), _mark(cursor, mark)
    return value >= mark if inclusive else value > mark


def back(cursor: Cursor, mark: str, overlap: timedelta) -> str:
    """The mark less an overlap; integers and texts that aren't marks stay."""
    if cursor.kind != TIMESTAMP or not mark:
        return mark
    at = parsed_mark(mark)
    return mark if at is None else (at - overlap).isoformat(sep=" ", timespec="milliseconds")


def lag_seconds(cursor: Cursor, mark: str, now: datetime) -> float | None:
    """Seconds between a timestamp mark and now; None where there is no such thing."""
    if cursor.kind != TIMESTAMP or not mark:
        return None
    at = parsed_mark(mark)
    return None if at is None else (now - at.replace(tzinfo=UTC)).total_seconds()


def open_rows(state: str, terminal) -> Column:
    """Rows whose state is null or not a terminal one."""
    c = F.col(f"`{state}`")
    return c.isNull() | ~c.isin(*terminal) if terminal else F.lit(True)
