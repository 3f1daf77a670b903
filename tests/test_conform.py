import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, StructType, TimestampNTZType

from tidemark.operators.conform import conform, rejects

SCHEMA = StructType().add("id", ByteType()).add("price", DecimalType(5, 2)).add("day", DateType())


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, price string, day timestamp_ntz, extra string")


def test_conform_casts_and_keeps_nulls(spark):
    moment = dt.datetime(2024, 3, 1)  # a time of day would be lost
    out = conform(frame(spark, [(1, "2.50", moment, "x"), (None, None, None, None)]), SCHEMA, drop_unnamed=True)
    assert out.schema.simpleString() == "struct<id:tinyint,price:decimal(5,2),day:date>"
    assert [tuple(r) for r in out.collect()] == [(1, Decimal("2.50"), dt.date(2024, 3, 1)), (None, None, None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("row, column", [((300, "1", None, ""), "id"), ((1, "1000.00", None, ""), "price"),
                                         ((1, "abc", None, ""), "price")])
def test_conform_fails_by_name(spark, row, column, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=f"column {column} as .* cannot hold"):
            conform(frame(spark, [row]), SCHEMA, drop_unnamed=True).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_rejects_lists_the_columns(spark):
    rows = [(1, "1", None, "good"), (300, "1", None, "a"), (300, "abc", None, "b"), (None, None, None, "nulls")]
    found = {r.extra: r.rejected for r in rejects(frame(spark, rows), SCHEMA).collect()}
    assert found == {"a": ["id"], "b": ["id", "price"]}


def test_truncate_seconds(spark):
    moment = dt.datetime(2024, 3, 1, 12, 30, 15, 123456)
    schema = StructType().add("day", TimestampNTZType())
    kept = conform(frame(spark, [(1, "1", moment, "")]), schema, drop_unnamed=True).first()[0]
    cut = conform(frame(spark, [(1, "1", moment, "")]), schema, truncate_seconds=True, drop_unnamed=True).first()[0]
    assert kept == moment and cut == moment.replace(microsecond=0)


@pytest.mark.parametrize("value, kind, target", [
    (1.9, "double", "int"), ("2024-01-01 13:00:00", "timestamp_ntz", "date"), (1e300, "double", "float")])
def test_values_that_would_lose_something(spark, value, kind, target):
    df = spark.range(1).select(F.lit(value).cast(kind).alias("c"))
    schema = spark.range(0).select(F.lit(None).cast(target).alias("c")).schema
    assert rejects(df, schema).first().rejected == ["c"]
    with pytest.raises(Exception, match="cannot hold"):
        conform(df, schema).collect()


def test_columns_without_a_type(spark):
    df = spark.range(1).withColumn("more", F.lit(1))
    schema = spark.range(0).schema
    with pytest.raises(ValueError, match="more"):
        conform(df, schema)
    assert conform(df, schema, drop_unnamed=True).columns == ["id"]


LOSES = [
    ("bigint", 9007199254740993, "double"), ("bigint", 9223372036854775807, "double"), ("int", 16777217, "float"), ("bigint", 16777217, "float"),
    ("string", "2024-01-01 13:00:00", "date"), ("string", "2024-01-01T00:00:01", "date"), ("double", 9.223372036854775807e18, "bigint"),
    ("float", 2147483648.0, "int"), ("double", 0.1, "float"), ("double", 1e300, "float"), ("double", 1.5, "int"), ("decimal(10,2)", Decimal("1.25"), "int"),
    ("string", "1.5", "int"), ("string", "12x", "int"), ("string", "1e400", "double"), ("int", 2, "boolean"), ("bigint", 300, "tinyint"),
    ("timestamp_ntz", dt.datetime(2024, 1, 1, 1), "date"), ("string", "2024-01-01 00:00:00.1234567", "timestamp_ntz"), ("decimal(38,0)", Decimal(10) ** 37, "decimal(10,0)"),
]
KEEPS = [
    ("bigint", 9007199254740992, "double", 9007199254740992.0), ("int", -16777216, "float", -16777216.0), ("bigint", -(2**63), "double", -(2.0**63)),
    ("string", "2024-01-01", "date", dt.date(2024, 1, 1)), ("string", " 2024-01-01 00:00:00 ", "date", dt.date(2024, 1, 1)), ("double", 0.5, "float", 0.5),
    ("string", "12", "int", 12), ("string", " -7 ", "bigint", -7), ("string", "0.1", "double", 0.1), ("string", "1e300", "double", 1e300),
    ("double", -(2.0**63), "bigint", -(2**63)), ("int", 1, "boolean", True), ("double", float("inf"), "float", float("inf")),
    ("timestamp_ntz", dt.datetime(2024, 1, 1), "date", dt.date(2024, 1, 1)), ("decimal(10,3)", Decimal("1.255"), "decimal(10,2)", Decimal("1.26")),
    ("smallint", 7, "bigint", 7), ("date", dt.date(2024, 1, 1), "string", "2024-01-01"),
]


@pytest.mark.parametrize("kind, value, target", LOSES)
def test_what_would_lose_something_is_refused_and_listed(spark, kind, value, target):
    schema = StructType.fromDDL(f"x {target}")
    df = spark.createDataFrame([(value,), (None,)], f"x {kind}")
    assert [r.rejected for r in rejects(df, schema).collect()] == [["x"]]
    with pytest.raises(Exception, match="cannot hold"):
        conform(df, schema).collect()


def test_what_fits_is_kept(spark):
    for kind, value, target, want in KEEPS:
        schema = StructType.fromDDL(f"x {target}")
        df = spark.createDataFrame([(value,), (None,)], f"x {kind}")
        assert rejects(df, schema).isEmpty(), (kind, value, target)
        assert [r.x for r in conform(df, schema).collect()] == [want, None]
