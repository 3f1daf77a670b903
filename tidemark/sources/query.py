"""The source relation of a transfer: a query, with or without a range."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.catalog import quoted
from tidemark.operators.conform import conform
from tidemark.operators.mark import Mark
from tidemark.plans.spec import MARK_PARAMETER, TransferSpec
from tidemark.sources.jdbc import read_jdbc


def source_frame(spark: SparkSession, spec: TransferSpec, mark: Mark | None = None) -> DataFrame:
    """The rows of the source; with a mark, those its range clause lets through."""
    clause = spec.range_clause if mark is not None else None
    query, args = spec.query, dict(spec.args or {})
    if isinstance(clause, str):
        query = f"{query} {mark.put_into(clause)}"
        if f":{MARK_PARAMETER}" in clause:
            args[MARK_PARAMETER] = mark.literal()
    if spec.frame is not None:
        df = spec.frame(spark)
    elif spec.jdbc is not None:
        df = read_jdbc(spark, spec.jdbc, query)
    else:
        df = spark.sql(query, args=args)
    if callable(clause):
        df = df.where(clause(mark.literal()))
    if spec.schema is not None:
        df = conform(df, spec.schema, spec.truncate_seconds)
    return df


@contextmanager
def source_view(spark: SparkSession, spec: TransferSpec, mark: Mark | None = None) -> Iterator[str]:
    """The source relation under a name, for as long as the block runs."""
    name = f"tmp_{spec.alias}__source_{uuid.uuid4().hex[:12]}"  # other runs may have the same alias
    source_frame(spark, spec, mark).createOrReplaceTempView(name)
    try:
        yield name
    finally:
        spark.catalog.dropTempView(name)


def describe_source(df: DataFrame, count_nulls: bool = False) -> DataFrame:
    """Position, name, type and nullability of each column, from analysis alone.

    File and JDBC readers call every column nullable. ``count_nulls`` adds what
    one pass over the rows finds: a row per task is exchanged, no more.
    """
    columns = df.schema.fields
    if count_nulls:
        rows = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.count_if(F.col(quoted(f.name)).isNull()).alias(f"nulls_{i}") for i, f in enumerate(columns)),
        )
    else:
        rows = df.sparkSession.range(1)
    described = F.array(*(
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
            *([F.col("rows"), F.col(f"nulls_{i}").alias("nulls")] if count_nulls else []),
        )
        for i, f in enumerate(columns)
    ))
    return rows.select(F.inline(described))
