"""Small frames from values, without a Python job."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructType


def _literal(value: Any, kind: DataType) -> Column:
    if isinstance(kind, StructType) and value is not None:
        return F.struct(*(_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)))
    return F.lit(value).cast(kind)


def literal_frame(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Rows given by the caller as one partition of literals."""
    structs = [_literal(row, schema) for row in rows]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
