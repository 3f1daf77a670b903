"""Source column types to target types, as column expressions.

The expressions run over a frame of catalogue rows (one row per column of a
source database), so a whole database is mapped in one job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tidemark.functions.literals import literal_frame

# Target type name and Spark type for each word a type text
# starts with. Words that are not listed map to String.
TYPE_WORDS = {
    "tinyint": ("Int32", "int"),
    "smallint": ("Int32", "int"),
    "mediumint": ("Int32", "int"),
    "int": ("Int32", "int"),
    "integer": ("Int32", "int"),
    "bigint": ("Int64", "bigint"),
    "float": ("Float32", "float"),
    "double": ("Float64", "double"),
    "datetime": ("DateTime", "timestamp"),
    "timestamp": ("DateTime", "timestamp"),
    "date": ("Date", "date"),
    "boolean": ("UInt8", "smallint"),
}
# The same for integer words when the text says "unsigned".
UNSIGNED_WORDS = {
    "tinyint": ("UInt32", "bigint"),
    "smallint": ("UInt32", "bigint"),
    "mediumint": ("UInt32", "bigint"),
    "int": ("UInt32", "bigint"),
    "integer": ("UInt32", "bigint"),
    "bigint": ("UInt64", "decimal(20,0)"),
}
# Type texts that are the bare word, without a display width.
BARE_WORDS = {
    "tinyint": ("Int8", "tinyint"),
    "smallint": ("Int16", "smallint"),
    "mediumint": ("Int32", "int"),
}
OTHER = ("String", "string")
MAX_PRECISION = 38


def _lookup(table: dict[str, tuple[str, str]], side: int, key: Column) -> Column:
    entries = ", ".join(f"'{word}', '{pair[side]}'" for word, pair in table.items())
    return F.try_element_at(F.expr(f"map({entries})"), key)


def _parsed(type_text: Column) -> Column:
    """The lower-cased text, its first word and its runs of digits."""
    text = F.trim(F.lower(type_text))
    return F.struct(
        text.alias("text"),
        F.regexp_extract(text, r"^([a-z]+)", 1).alias("word"),
        F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)).alias("numbers"),
    )


def _mapped(parsed: Column, side: int, decimal: str) -> Column:
    text, word, numbers = (parsed.getField(name) for name in ("text", "word", "numbers"))
    digits = F.concat_ws(",", F.slice(numbers, 1, 2))
    decimal_text = F.when(F.size(numbers) >= 2, F.concat(F.lit(decimal), F.lit("("), digits, F.lit(")")))
    bits = F.coalesce(F.get(numbers, F.lit(0)).try_cast("int"), F.lit(1))
    small, large, full = (("UInt8", "UInt64", "UInt64"), ("smallint", "bigint", "decimal(20,0)"))[side]
    return (
        F.when(word == "decimal", decimal_text)
        .when(word == "bit", F.when(bits == 1, small).when(bits < 64, large).otherwise(full))
        .when(text.contains("unsigned"), F.coalesce(
            _lookup(UNSIGNED_WORDS, side, word), _lookup(TYPE_WORDS, side, word), F.lit(OTHER[side])))
        .otherwise(F.coalesce(
            _lookup(BARE_WORDS, side, text), _lookup(TYPE_WORDS, side, word), F.lit(OTHER[side])))
    )


def _problem(parsed: Column) -> Column:
    numbers = parsed.getField("numbers")
    precision = F.get(numbers, F.lit(0)).try_cast("int")
    scale = F.get(numbers, F.lit(1)).try_cast("int")
    return F.when(
        parsed.getField("word") == "decimal",
        F.when(F.size(numbers) < 2, F.lit("decimal without precision and scale"))
        .when(precision.isNull() | (precision > MAX_PRECISION), F.lit(f"decimal precision above {MAX_PRECISION}"))
        .when(scale.isNull() | (scale > precision), F.lit("decimal scale above precision")),
    )


def _target(parsed: Column, nullable: Column | None) -> Column:
    name = _mapped(parsed, 0, "Decimal")
    if nullable is None:
        return name
    return F.when(nullable, F.concat(F.lit("Nullable("), name, F.lit(")"))).otherwise(name)


def target_type(type_text: Column, nullable: Column | None = None) -> Column:
    """Target type text, wrapped in ``Nullable(...)`` for nullable columns."""
    return _target(_parsed(type_text), nullable)


def type_problem(type_text: Column) -> Column:
    """Why a type text has no Spark type; NULL where it has one."""
    return _problem(_parsed(type_text))


def spark_type(type_text: Column) -> Column:
    """Spark type text; NULL where :func:`type_problem` names a problem."""
    parsed = _parsed(type_text)
    return F.when(_problem(parsed).isNull(), _mapped(parsed, 1, "decimal"))


def map_catalogue(rows: DataFrame, type_column: str = "type_text", nullable_column: str = "nullable") -> DataFrame:
    """Add target type, Spark type and problem to a frame of catalogue rows.

    Each text is parsed once, in a projection of its own.
    """
    parsed = F.col("__parsed")
    return rows.withColumn("__parsed", _parsed(F.col(type_column))).select(
        *rows.columns,
        _target(parsed, F.col(nullable_column)).alias("target_type"),
        F.when(_problem(parsed).isNull(), _mapped(parsed, 1, "decimal")).alias("spark_type"),
        _problem(parsed).alias("problem"),
    )


def mapped_schema(spark: SparkSession, columns: Iterable[tuple[str, str, bool]]) -> StructType:
    """Spark schema of one table from its (column, type text, nullable) rows.

    The rows are metadata of a single table, so they are brought to the driver.
    """
    rows = [(i, name, text, bool(nullable)) for i, (name, text, nullable) in enumerate(columns)]
    frame = literal_frame(
        spark, rows, StructType.fromDDL("position int, name string, type_text string, nullable boolean"))
    fields = []
    for row in map_catalogue(frame).orderBy("position").collect():
        if row.problem:
            raise ValueError(f"column {row.name}: {row.problem} in {row.type_text!r}")
        fields.append(StructField(row.name, DataType.fromDDL(row.spark_type), row.nullable))
    return StructType(fields)
