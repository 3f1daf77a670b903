"""Merge the small files of a log table while others append to it.

A log gets a file for each row. Its rows are written again, to few files in a new folder, a generation, and the
catalogue is then pointed at that folder, in one step. Rows that others append meanwhile are kept: files that came up to the last look are
copied too, and those that land in the former generation later, from a writer that began before the swap, are moved over.

A file beside the new generation names the former one and the files of it that were taken, so no row is lost or doubled
if the driver is lost: before the swap the new folder is nobody's and is freed by the next compaction; after it, what is left in the
former generation is moved by the next one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.operators import files
from tidemark.operators.catalog import quoted, sql_text, table_detail

_FORMER = "_former"


def _rows(spark: SparkSession, schema: StructType, *paths: str) -> DataFrame:
    return spark.newSession().read.schema(schema).parquet(*paths)  # a new session lists files anew


def _name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def _bytes(spark: SparkSession, folder: str) -> int:
    listed = spark.newSession().read.format("binaryFile").load(folder)
    return listed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def _point(spark: SparkSession, table: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION {sql_text(folder)}")


def _carry(spark: SparkSession, schema: StructType, former: str, taken: set[str], current: str) -> int:
    """Move the files of a former generation that were not taken; returns their number."""
    if not files.exists(spark, former):
        return 0
    late = [f for f in _rows(spark, schema, former).inputFiles() if _name(f) not in taken]
    for path in late:
        files.move(spark, f"{former}/{_name(path)}", current)
    return len(late)


def compact_log(spark: SparkSession, table: str, least_files: int = 32, file_bytes: int = 128 << 20) -> int:
    """Merge the files of an unpartitioned log table of Parquet files; returns how many were merged.

    Nothing is done below ``least_files``. A log smaller than ``file_bytes`` ends in one file, a larger one in files of about that
    size. Others may append and read all the while; only one compaction of a table may run at a time. A row
    that is appended between the last look and the swap is not seen until it is moved, right after the swap. The former generation stays for
    readers and late writers until the next compaction.
    """
    detail = table_detail(spark, table)
    if detail.get("partition_columns"):
        raise ValueError(f"{table} is partitioned")
    schema, current = spark.table(table).schema, files.same_place(spark, detail["location"])
    base = spark.catalog.getDatabase(quoted(detail["namespace"][-1])).locationUri.rstrip("/")
    prefix = f"{detail['table_name']}__g_"
    text = files.read_text(spark, f"{current}/{_FORMER}")
    former = json.loads(text) if text else None
    if former:
        _carry(spark, schema, former["folder"], set(former["taken"]), current)
    held = {current, former["folder"] if former else None}
    for folder in files.folders(spark, base, prefix):  # of a compaction that did not come to its swap
        if files.same_place(spark, folder) not in held:
            files.delete(spark, folder)

    rows = _rows(spark, schema, current)
    taken = {_name(f) for f in rows.inputFiles()}
    if len(taken) < max(2, least_files):
        return 0
    folder = files.same_place(spark, f"{base}/{prefix}{uuid.uuid4().hex}")
    number = -(-_bytes(spark, current) // file_bytes)
    (rows.repartition(number) if number > 1 else rows.coalesce(1)).write.parquet(folder)
    late = [f for f in _rows(spark, schema, current).inputFiles() if _name(f) not in taken]
    if late:
        _rows(spark, schema, *late).coalesce(1).write.mode("append").parquet(folder)
        taken |= {_name(f) for f in late}
    files.write_text(spark, f"{folder}/{_FORMER}", json.dumps({"folder": current, "taken": sorted(taken)}))
    _point(spark, table, folder)
    spark.catalog.refreshTable(table)
    if _carry(spark, schema, current, taken, folder):
        spark.catalog.refreshTable(table)
    if former:
        files.delete(spark, former["folder"])
    return len(taken)
