"""Conform rows to a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, FractionalType, IntegerType, IntegralType, LongType,
    NumericType, ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType)

from tidemark.operators.catalog import quoted

_WIDTHS = {ByteType: 1, ShortType: 2, IntegerType: 4, LongType: 8}


def _survives(source: DataType, field: StructField) -> Column:
    """Whether a cast keeps the value, for a value that can be cast; only the scale of decimals may be cut.

    By the pair of types:

    * to whole numbers, and from whole numbers to floating point: the value cast back must be the same, and inside the range
      of the source (2**63 as a double is no bigint, but is cast to the largest one);
    * between floating point: a finite number stays finite, and a double to float only if it is that float;
    * to decimals: a finite number; to floating point from decimals: finite;
    * to dates: a time of day of midnight only, also in text; to boolean: 0, 1 or text that names a truth value;
    * text to a number: what the number says must be the same as decimals, so no digit is dropped.
    """
    column, target = F.col(quoted(field.name)), field.dataType
    cast = column.try_cast(target)
    same = cast.try_cast(source) == column
    if isinstance(target, IntegralType) and isinstance(source, (FractionalType, DecimalType)):
        if isinstance(source, (FloatType, DoubleType)):  # a bound that is no float is rounded up to one
            return same & (column < F.lit(float(2 ** (8 * _WIDTHS[type(target)] - 1))))
        return same
    if isinstance(target, (FloatType, DoubleType)) and isinstance(source, IntegralType):
        return same & (cast < F.lit(float(2 ** (8 * _WIDTHS[type(source)] - 1))))
    if isinstance(target, FloatType) and isinstance(source, DoubleType):
        return same | F.isnan(column)
    if isinstance(target, (FloatType, DoubleType)) and isinstance(source, DecimalType):
        return F.abs(cast) != float("inf")
    if isinstance(target, DateType) and isinstance(source, (TimestampType, TimestampNTZType)):
        return same
    if isinstance(target, BooleanType) and isinstance(source, NumericType):
        return column.isin(0, 1)
    if isinstance(source, StringType):
        text = F.trim(column)
        if isinstance(target, DateType):
            return cast.cast("timestamp_ntz") == text.try_cast("timestamp_ntz")
        if isinstance(target, (IntegralType, FloatType, DoubleType)):
            exact = text.try_cast("decimal(38,18)")
            if isinstance(target, IntegralType):
                return exact == cast.cast("decimal(38,18)")
            # Beyond what a decimal holds, and for text in another form, the value itself is all there is.
            finite = F.abs(cast) != float("inf")
            named = F.lower(text).rlike("inf|nan")
            return named | finite
        if isinstance(target, TimestampNTZType):
            return ~text.rlike(r"\.\d{7}")  # a stamp holds microseconds
        if isinstance(target, TimestampType):
            return ~text.rlike(r"\.\d{7}")
    return F.lit(True)


def _refused(source: DataType, field: StructField) -> Column:
    column = F.col(quoted(field.name))
    return column.isNotNull() & ~(column.try_cast(field.dataType).isNotNull() & F.coalesce(_survives(source, field), F.lit(False)))


def _fitted(source: DataType, field: StructField) -> Column:
    """The column as its target type; the job fails, naming the value, if that cannot hold it."""
    column = F.col(quoted(field.name))
    if source == field.dataType:
        return column
    message = F.concat(
        F.lit(f"column {field.name} as {field.dataType.simpleString()} cannot hold "), column.cast("string"))
    failure = F.raise_error(message).cast(field.dataType)
    return F.when(_refused(source, field), failure).otherwise(column.try_cast(field.dataType))


def conform(df: DataFrame, schema: StructType, truncate_seconds: bool = False, drop_unnamed: bool = False) -> DataFrame:
    """Select and cast the columns of ``schema``; a value that does not fit, or would lose something, fails the job.

    Columns that ``schema`` does not name are refused, unless ``drop_unnamed``.
    """
    named = {field.name.lower() for field in schema.fields}
    unnamed = [c for c in df.columns if c.lower() not in named]
    if unnamed and not drop_unnamed:
        raise ValueError(f"columns without a type: {', '.join(unnamed)}")
    columns = []
    for field in schema.fields:
        column = _fitted(df.schema[field.name].dataType, field)
        if truncate_seconds and isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            column = F.date_trunc("second", column).cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def rejects(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows with a value that does not fit, with the names of those columns."""
    names = F.filter(
        F.array(*(F.when(_refused(df.schema[f.name].dataType, f), F.lit(f.name)) for f in schema.fields)), lambda name: name.isNotNull())
    return df.withColumn("rejected", names).where(F.size("rejected") > 0)
