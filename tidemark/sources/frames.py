"""DataFrames (Parquet tables among them) as a source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.schema import LiveTable

_DECLARED = ((T.BooleanType, "BOOLEAN"), (T.IntegralType, "INTEGER"), (T.FractionalType, "DOUBLE"), (T.BinaryType, "BLOB"), ((T.TimestampType, T.TimestampNTZType, T.DateType), "TIMESTAMP"))


def declared(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return "NUMERIC"
    return next((name for own, name in _DECLARED if isinstance(kind, own)), "TEXT")


class FrameSource:
    """tables: name -> DataFrame; keys: name -> key columns; order: name -> columns that settle which row of a key is last."""

    def __init__(self, tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None, order: dict[str, list[str]] | None = None):
        self.tables, self.keys, self.order = tables, keys or {}, order or {}

    def reflect(self) -> dict[str, LiveTable]:
        return {n: LiveTable(n, [(f.name, declared(f.dataType)) for f in df.schema], self.keys.get(n, [])) for n, df in self.tables.items()}

    def read(self, table: str, columns: list[str], floor: tuple[str, str] | None = None) -> DataFrame:
        """floor is for sources that Spark's own pushdown doesn't reach."""
        if not columns:
            raise ValueError(f"{table}: no columns to read")
        df = self.tables[table]
        order = F.struct(*self.order[table]) if table in self.order else F.struct(*df.columns)
        return df.select(*columns, order.alias("_order"))

    def count(self, table: str) -> int:
        return self.tables[table].count()
