from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import convert, refusal
from tidemark.functions.cursor import Cursor, advance, back, cursor_value, lag_seconds, max_cursor
from tidemark.functions.predicates import Filter, compile_filters
from tidemark.functions.templates import Extra, parts
from tidemark.functions.types import affinity, map_column, parse_type

TS = Cursor("v", "timestamp")


@pytest.mark.parametrize(
    ("declared", "want"),
    [("INTEGER PRIMARY KEY", "bigint"), ("DOUBLE PRECISION", "double precision"), ("varchar(20)", "text"), ("", "bytea"), ("BOOL", "boolean"), ("DATETIME", "timestamptz"), ("DATE", "timestamptz"),
     ("TIMESTAMP", "timestamptz"), ("BLOB", "bytea"), ("REAL", "double precision"), ("DECIMAL(10,2)", "numeric"), ("UNSIGNED BIG INT", "numeric"), ("CLOB", "text")],
)
def test_affinity(declared, want):
    assert affinity(declared) == want


def test_types():
    assert map_column("a", "TEXT", ["a"]) == "jsonb"
    assert parse_type("Double  Precision") == "double precision"
    with pytest.raises(ValueError):
        parse_type("money")


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame([(1, "success", 1.0), (2, "failed", 2.0), (3, None, 3.0), (4, "running", None)], "id long, status string, cost double")


@pytest.mark.parametrize(
    ("f", "want"),
    [(Filter("status", "eq", "success"), [1]), (Filter("status", "ne", "failed"), [1, 3, 4]), (Filter("status", "in", ["success", "failed"]), [1, 2]), (Filter("status", "not_in", ["failed"]), [1, 3, 4]),
     (Filter("cost", "gt", 1.5), [2, 3]), (Filter("status", "is_null"), [3]), (Filter("cost", "not_null"), [1, 2, 3]), (Filter("status", "like", "S%"), [1]), (Filter("cost", "gte", 2.0, True), [2, 3, 4]),
     (Filter("cost", "lt", 2.0), [1]), (Filter("cost", "lte", 2.0), [1, 2])],
)
def test_filters(golden, f, want):
    assert not f.problems()
    assert [r.id for r in golden.where(compile_filters([f])).orderBy("id").collect()] == want


@pytest.mark.parametrize(
    ("f", "want"),
    [(Filter("status", "eq", 10), []), (Filter("status", "lt", 10), []), (Filter("status", "ne", 1), [1, 2, 3, 4]), (Filter("cost", "eq", "2"), [2]), (Filter("cost", "gt", "1.5"), [2, 3]),
     (Filter("cost", "lt", "word"), [1, 2, 3]), (Filter("cost", "gt", "word"), []), (Filter("cost", "ne", "word"), [1, 2, 3, 4]), (Filter("cost", "in", ["1", "word"]), [1]),
     (Filter("cost", "in", ["word"]), []), (Filter("cost", "not_in", ["word", 3]), [1, 2, 4]), (Filter("id", "eq", True), [1]), (Filter("id", "gte", " 3 "), [3, 4]), (Filter("status", "like", 1), [])],
)
def test_filters_of_other_types(golden, f, want):
    """As the source compares: text columns as text; text that reads as a number is one for a number column, other text lies above."""
    assert [r.id for r in golden.where(compile_filters([f], golden.schema)).orderBy("id").collect()] == want


def test_native_timestamps_are_pushed(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    texts = ["2026-01-01 00:00:00.0004", "2026-01-01 00:00:00.0005", "2026-01-01 00:00:00.001", "2026-01-01 00:00:00.0015", None]
    spark.createDataFrame([(t,) for t in texts], "v string").select(F.col("v").cast("timestamp").alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    for inclusive in (True, False):
        own, other = (advance(TS, "2026-01-01 00:00:00.001", inclusive, kind) for kind in (T.TimestampType(), None))
        assert df.where(own).count() == df.where(other).count() == (3 if inclusive else 1)
        assert "GreaterThanOrEqual(v" in df.where(own)._jdf.queryExecution().toString()


def test_like_is_ascii_only(spark):
    df = spark.createDataFrame([("É\\x",), ("é\\X",)], "s string")
    assert [r.s for r in df.where(Filter("s", "like", "é\\x").condition()).collect()] == ["é\\X"]


@pytest.mark.parametrize("f", [Filter("a b", "eq", 1), Filter("a", "near", 1), Filter("a", "is_null", 1), Filter("a", "in", []), Filter("a", "in", "x"), Filter("a", "eq", None), Filter("a", "eq", [1])])
def test_filter_problems(f):
    assert f.problems()


def test_cursor(spark):
    df = spark.createDataFrame([("2026-08-06 23:00:00-04:00",), ("2026-08-07 02:00:00+00:00",), ("garbage",), ("10:00:00",), (None,), ("2026-01-01 00:00:00 -0400 EDT",)], "v string")
    assert max_cursor(df, TS) == "2026-08-07 03:00:00.000"
    assert df.where(advance(TS, "2026-08-07 02:00:00.000")).count() == 1
    assert df.where(advance(TS, "2026-08-07 02:00:00.000", True)).count() == 2
    assert df.where(advance(TS, "")).count() == 6
    rounded = spark.createDataFrame([("2026-01-01 00:00:00.1236",)], "v string").select(cursor_value(TS)).first()[0]
    assert rounded == "2026-01-01 00:00:00.124"
    assert max_cursor(df.limit(0), TS) == ""


def test_overlap_and_lag():
    assert back(TS, "2026-01-01 00:00:10.000", timedelta(seconds=30)) == "2025-12-31 23:59:40.000"
    assert back(TS, "odd", timedelta(seconds=30)) == "odd"
    assert back(Cursor("id", "integer"), "5", timedelta(seconds=30)) == "5"
    assert lag_seconds(TS, "2026-01-01 00:00:00.000", datetime(2026, 1, 1, 0, 0, 4, 500000, UTC)) == 4.5
    assert lag_seconds(Cursor("id", "integer"), "5", datetime.now(UTC)) is None


def test_timestamps(spark):
    texts = ["2026-08-01T10:00:00Z", "2026-08-01 06:00:00.000000000-04:00", "2026-08-01 10:00:00", "2026-08-01 06:00:00 -0400 EDT", "2026-08-01 06:00:00 -0400 EDT m=+0.12", "not a timestamp at all", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(F.date_format(convert(F.col("t"), T.StringType(), "timestamptz"), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2026-08-01 10:00"] * 5 + [None] * 3


def test_other_conversions(spark):
    df = spark.createDataFrame([(1, '{"ok":true}', "5"), (0, "", "x"), (None, "no json", None)], "b int, j string, n string")
    rows = df.select(convert(F.col("b"), T.IntegerType(), "boolean"), convert(F.col("j"), T.StringType(), "jsonb"), refusal(F.col("j"), T.StringType(), "jsonb", "j"), refusal(F.col("n"), T.StringType(), "bigint", "n")).collect()
    assert [r[0] for r in rows] == [True, False, None]
    assert [r[1] for r in rows] == ['{"ok":true}', None, "no json"]
    assert [bool(r[2]) for r in rows] == [False, False, True]
    assert [bool(r[3]) for r in rows] == [False, True, False]


def test_templates(spark):
    df, now = spark.createDataFrame([("x", 5), (None, None)], "a string, n long"), datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC)

    def values(template, kind=None):
        return [r[0] for r in df.select(Extra(template, kind).column(df.schema, "t", "here", now, {"HOME_X": "h"})).collect()]

    assert values("${table}/${source.instance}/${row.a}-${row.n}") == ["t/here/x-5", "t/here/-"]
    assert values("${env:HOME_X}${env:GONE}") == ["h", "h"]
    assert values("${now}")[0] == datetime(2026, 1, 2, 3, 4, 5)
    assert values("nonsense", "timestamptz")[0] == datetime(2026, 1, 2, 3, 4, 5)
    assert values("12", "bigint") == [12, 12]
    assert Extra("123").resolved_type() == "text"
    assert Extra("${now}").resolved_type() == "timestamptz"
    assert Extra("a${row.x}${row.y}").references() == ["x", "y"]
    with pytest.raises(ValueError):
        values("${row.gone}")
    with pytest.raises(ValueError):
        parts("${now")
    assert Extra("${sum(1)}").problems("e") and Extra("${env:low}").problems("e") and Extra("x", "money").problems("e")
