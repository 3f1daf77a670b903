"""High-water mark: the largest key value of a target table."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators.catalog import field_of, quoted
from tidemark.plans.spec import MARK_TEXT

_LITERALS = {
    T.ByteType: "{}Y",
    T.ShortType: "{}S",
    T.IntegerType: "{}",
    T.LongType: "{}L",
    T.FloatType: "{}F",
    T.DoubleType: "{}D",
    T.DecimalType: "{}BD",
    T.DateType: "DATE'{}'",
    T.TimestampNTZType: "TIMESTAMP_NTZ'{}'",
}


@dataclass(frozen=True)
class Mark:
    """A mark with its column type.

    ``value`` is the ISO text for range clauses, in the time zone of the session.
    ``exact`` is the same in every session: for a timestamp, microseconds since
    1970, so that no hour is ambiguous.
    """

    value: str = field(compare=False)
    exact: str
    type: T.DataType

    def literal(self) -> Column:
        """The mark as a literal of the column's own type, so that filters push down."""
        if isinstance(self.type, T.StringType):
            return F.lit(self.exact)
        if isinstance(self.type, T.TimestampType):
            moment = datetime(1970, 1, 1) + timedelta(microseconds=int(self.exact))
            return F.expr(f"TIMESTAMP'{moment.isoformat()}Z'")
        if isinstance(self.type, (T.DoubleType, T.FloatType)) and not math.isfinite(float(self.exact)):
            return F.lit(self.exact).cast(self.type)
        form = _LITERALS.get(type(self.type))
        if form is None:
            raise TypeError(f"no high-water mark over {self.type.simpleString()}")
        return F.expr(form.format(self.exact))

    def put_into(self, range_clause: str) -> str:
        """Replace each ``{max_primary_key}`` of a range clause."""
        if MARK_TEXT in range_clause and re.search(r"['\\]", self.value):
            raise ValueError(f"mark {self.value!r} cannot stand in SQL text; bind :max_primary_key")
        return range_clause.replace(MARK_TEXT, self.value)


def metadata_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for questions that file footers answer.

    Only the settings of the new session differ. The Parquet reader then takes a
    row count from the footers, and many files are packed into each task, as
    hardly any bytes are read from one. A new session also lists the files anew.
    """
    session = spark.newSession()
    for key, value in {
        "spark.sql.sources.useV1SourceList": "",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.files.maxPartitionBytes": "16g",
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
    }.items():
        session.conf.set(key, value)
    return session


def mark_texts(edge: Column, kind: T.DataType) -> tuple[Column, Column]:
    """The ``value`` and ``exact`` texts of a column that holds a mark."""
    exact = F.unix_micros(edge) if isinstance(kind, T.TimestampType) else edge
    return edge.cast("string").alias("value"), exact.cast("string").alias("exact")


def _edge(source: DataFrame, key: T.StructField, pick: Callable[[Column], Column]) -> Mark | None:
    edge = source.agg(pick(F.col(quoted(key.name))).alias("edge"))
    row = edge.select(*mark_texts(F.col("edge"), key.dataType)).first()
    return None if row.value is None else Mark(row.value, row.exact, key.dataType)


def low_mark(df: DataFrame, column: str) -> Mark | None:
    """The smallest value of a column."""
    return _edge(df, field_of(df.schema, column), F.min)


def high_key(df: DataFrame, column: str) -> Mark | None:
    """The largest value of a column."""
    return _edge(df, field_of(df.schema, column), F.max)


def high_water_mark(spark: SparkSession, table: str, column: str, at_least: Mark | None = None) -> Mark | None:
    """The largest value of a column; None for a table without one.

    Only that column is read. When a value is known that the mark has already
    reached, the filter on it leaves the footers of all files and the row groups
    that can hold it or a larger one. Should no row be that large any more, the
    column is read whole.
    """
    source = metadata_session(spark).table(table)
    key = field_of(source.schema, column)
    if at_least is not None:
        mark = _edge(source.where(F.col(quoted(key.name)) >= at_least.literal()), key, F.max)
        if mark is not None:
            return mark
    return _edge(source, key, F.max)
