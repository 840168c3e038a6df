"""Templates of extra columns: ``${now}``, ``${table}``, ``${source.instance}``, ``${env:NAME}``, ``${row.column}``."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .predicates import valid_identifier
from .types import parse_type, spark_type

_ENV = re.compile(r"[A-Z_][A-Z0-9_]*")


def parts(template: str) -> list[tuple[str, str]]:
    """("text" or "slot", content) in order; an unclosed slot is an error."""
    out, rest = [], template
    while "${" in rest:
        text, rest = rest.split("${", 1)
        if "}" not in rest:
            raise ValueError(f"unclosed ${{ in {template!r}")
        body, rest = rest.split("}", 1)
        out += [("text", text)] * bool(text) + [("slot", body)]
    return out + [("text", rest)] * bool(rest)


def _check(body: str) -> None:
    if body in ("now", "table", "source.instance"):
        return
    if body.startswith("env:"):
        if not _ENV.fullmatch(body[4:]):
            raise ValueError(f"invalid environment name in ${{{body}}}")
    elif not (body.startswith("row.") and valid_identifier(body[4:])):
        raise ValueError(f"unknown placeholder ${{{body}}}")


def instant(at: datetime) -> str:
    """RFC 3339 in UTC, without trailing zeros in the fraction."""
    at = at.astimezone(UTC)
    fraction = f".{at.microsecond:06d}".rstrip("0") if at.microsecond else ""
    return at.strftime("%Y-%m-%dT%H:%M:%S") + fraction + "Z"


def rendered(c: Column, kind: T.DataType) -> Column:
    """A row's value inside a template: null is empty. Doubles are written as Spark writes them."""
    if isinstance(kind, T.BinaryType):
        text = F.decode(c, "UTF-8")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        text = F.concat(whole, F.regexp_replace(F.regexp_replace(F.date_format(c, ".SSSSSS"), "0+$", ""), r"^\.$", ""), F.lit("Z"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


@dataclass(frozen=True)
class Extra:
    template: str
    type: str | None = None

    def problems(self, name: str) -> list[str]:
        found = []
        try:
            if self.type is not None:
                parse_type(self.type)
            for kind, body in parts(self.template):
                if kind == "slot":
                    _check(body)
        except ValueError as e:
            found.append(f"{name}: {e}")
        return found

    def resolved_type(self) -> str:
        """As declared; exactly ``${now}`` is a timestamp; anything else is text."""
        return parse_type(self.type) if self.type else "timestamptz" if self.template == "${now}" else "text"

    def references(self) -> list[str]:
        return [body[4:] for kind, body in parts(self.template) if kind == "slot" and body.startswith("row.")]

    def column(self, schema: T.StructType, table: str, instance: str, now: datetime, env: Mapping[str, str] = os.environ) -> Column:
        """The value of each row. What doesn't depend on the row is one literal; now is the same for a whole pass."""
        pieces: list[Column] = []
        fixed = {"now": instant(now), "table": table, "source.instance": instance}
        for kind, body in parts(self.template):
            if kind == "text":
                pieces.append(F.lit(body))
            elif body.startswith("row."):
                if body[4:] not in schema.names:
                    raise ValueError(f"${{{body}}}: no such column")
                pieces.append(rendered(F.col(f"`{body[4:]}`"), schema[body[4:]].dataType))
            else:
                pieces.append(F.lit(env.get(body[4:], "") if body.startswith("env:") else fixed[body]))
        text = F.concat(*pieces) if pieces else F.lit("")
        target = self.resolved_type()
        if target == "timestamptz":
            return F.coalesce(F.try_to_timestamp(text), F.lit(instant(now)).cast("timestamp"))
        return text if target in ("text", "jsonb") else text.cast("binary") if target == "bytea" else text.try_cast(spark_type(target))
