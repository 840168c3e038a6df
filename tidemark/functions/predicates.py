"""Filters on raw source columns: eleven operators, in the columns' types, with null rows kept by the negative ones."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,62}")


def valid_identifier(name: str) -> bool:
    return bool(_IDENTIFIER.fullmatch(name or ""))


def _like(c: Column, v: str) -> Column:
    # case is ignored for ASCII letters only, and a backslash is an ordinary character
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pattern = v.translate(str.maketrans(upper, lower)).replace("\\", "\\\\")
    return F.translate(c.cast("string"), upper, lower).like(pattern)


#: What a comparison is for every value that isn't null, where text stands against numbers: text is the greater.
_ABOVE = {"eq": False, "ne": True, "lt": True, "lte": True, "gt": False, "gte": False}


def _text(v: Any) -> str:
    return str(int(v)) if isinstance(v, bool) else str(v)


def _number(v: Any) -> int | float | None:
    """v as a number, where it reads as one."""
    if isinstance(v, (bool, int, float)):
        return int(v) if isinstance(v, bool) else v
    for kind in (int, float):
        try:
            return kind(v.strip()) if _NUMBER.fullmatch(v.strip()) else None
        except ValueError:  # noqa: PERF203
            continue
    return None


_NUMBER = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?")


def _sides(c: Column, v: Any, kind: T.DataType | None) -> tuple[Column, Column | None]:
    """Both sides of a comparison, in the column's type; no right side: v can't be in it, and is text against numbers.

    As in the source: a number against a text column is taken as text, text against a number column as the number that it reads as.
    """
    if isinstance(kind, T.StringType):
        return c, F.lit(_text(v))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        number = _number(v)
        return (c.cast("int") if isinstance(kind, T.BooleanType) else c), None if number is None else F.lit(number)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) and isinstance(v, str):
        return c, F.lit(v).try_cast(kind)
    if isinstance(kind, T.BinaryType):
        return c, F.lit(_text(v)).cast(kind)
    return c, F.lit(v)


def _compare(op: str) -> Callable[[Column, Any, T.DataType | None], Column]:
    tests = {"eq": operator.eq, "ne": lambda a, b: ~a.eqNullSafe(b), "lt": operator.lt, "lte": operator.le, "gt": operator.gt, "gte": operator.ge}

    def test(c: Column, v: Any, kind: T.DataType | None) -> Column:
        left, right = _sides(c, v, kind)
        if right is not None:
            return tests[op](left, right)
        return F.lit(True) if op == "ne" else F.when(c.isNotNull(), F.lit(_ABOVE[op]))

    return test


def _within(c: Column, values: Any, kind: T.DataType | None) -> Column:
    sides = [_sides(c, v, kind) for v in values]
    found = [right for _, right in sides if right is not None]
    return sides[0][0].isin(*found) if found else F.when(c.isNotNull(), F.lit(False))


_TESTS: dict[str, Callable[[Column, Any, T.DataType | None], Column]] = {
    **{op: _compare(op) for op in _ABOVE},
    "in": _within,
    "not_in": lambda c, v, kind: ~_within(c, v, kind) | c.isNull(),
    "like": lambda c, v, _: _like(c, _text(v)),
    "is_null": lambda c, *_: c.isNull(),
    "not_null": lambda c, *_: c.isNotNull(),
}
OPERATORS = tuple(sorted(_TESTS))


@dataclass(frozen=True)
class Filter:
    """column op value; or_null keeps null rows too (set by time windows only)."""

    column: str
    op: str
    value: Any = None
    or_null: bool = False

    def problems(self) -> list[str]:
        found = [] if valid_identifier(self.column) else [f"invalid column name {self.column!r}"]
        listed = isinstance(self.value, (list, tuple))
        if self.op not in _TESTS:
            found.append(f"{self.column}: unknown op {self.op!r}; one of {', '.join(OPERATORS)}")
        elif self.op in ("is_null", "not_null"):
            found += [f"{self.column}: {self.op} takes no value"] if self.value is not None else []
        elif self.op in ("in", "not_in"):
            found += [f"{self.column}: {self.op} takes a list of values"] if not listed or not self.value else []
        elif self.value is None or listed or isinstance(self.value, dict):
            found.append(f"{self.column}: {self.op} takes one value")
        return found

    def condition(self, kind: T.DataType | None = None) -> Column:
        """kind: the column's type, in which values are compared; without it they are compared as they are."""
        c = F.col(f"`{self.column}`")
        found = _TESTS[self.op](c, self.value, kind)
        return found | c.isNull() if self.or_null else found


def compile_filters(filters, schema: T.StructType | None = None) -> Column:
    """All of the filters; none of them: everything. With a schema, values are compared in their columns' types."""
    kinds = {f.name: f.dataType for f in schema} if schema else {}
    return reduce(lambda a, b: a & b, (f.condition(kinds.get(f.column)) for f in filters), F.lit(True))
