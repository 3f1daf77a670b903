"""Reports over transferred tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def year_max_topk(df: DataFrame, moment: str, value: str, k: int = 10, name: str = "max_value") -> DataFrame:
    """The ``k`` years with the largest value; years of equal value in order."""
    per_year = df.groupBy(F.year(moment).alias("year")).agg(F.max(value).alias(name))
    return per_year.orderBy(F.desc(name), "year").limit(k)


def left_join_projection(left: DataFrame, right: DataFrame, on: Column, columns: list[Column]) -> DataFrame:
    """Every left row with its match, if any, as the chosen columns.

    The join strategy is left to Spark: a small right side is broadcast by its
    size, and adaptive execution splits a left key that holds many rows.
    """
    return left.join(right, on, "left").select(*columns)
