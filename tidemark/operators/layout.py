"""Arrange rows for the files of a target."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.spec import Layout

_TASK = "__task"


def arrange(df: DataFrame, layout: Layout) -> DataFrame:
    """Distribute and sort rows as the layout asks; a plain sort shuffles nothing.

    Ranged layouts are range-partitioned by the sort columns and, within equal
    values, by the task a row came from. A value (or a row repeated many times)
    that holds a large share of all rows is so cut into several ranges, and still
    every file covers one range of the sort columns. The task number does not
    depend on the order of rows in a task, so a task that is run again after an
    executor is lost sends each row to the same range.

    Partitioned, spread and bucketed layouts use a rebalance, with which adaptive execution
    splits large partitions and merges small ones. A hot bucket so comes from several
    tasks, a file each; the writer sorts the rows of a bucketed table itself.
    """
    if layout.bucket_by:
        return df.hint("rebalance", layout.buckets, *(F.col(c) for c in layout.bucket_by))
    if layout.ranged:
        number = [layout.ranges] if layout.ranges else []
        df = df.withColumn(_TASK, F.spark_partition_id()).repartitionByRange(*number, *layout.sort_by, _TASK).drop(_TASK)
    elif layout.partition_by or layout.spread_by:
        df = df.hint("rebalance", *(F.col(c) for c in layout.partition_by or layout.spread_by))
    keys = [*layout.partition_by, *layout.sort_by]
    return df.sortWithinPartitions(*keys) if keys else df
