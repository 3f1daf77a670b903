"""Databases in the shared folder of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tidemark.operators.catalog import drop_table, quoted


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it.

    A local session without the setting gets a folder of its own; a cluster must
    name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors see")


def fresh_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{uuid.uuid4().hex}"


def fresh_database(spark: SparkSession) -> str:
    """A new database with a folder of its own."""
    name = f"tidemark_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_folder(spark)}'")
    return name


def release(spark: SparkSession, database: str) -> None:
    """Drop a working database and free the files of its tables; frames that read them end with it."""
    for table in spark.catalog.listTables(database):
        if not table.isTemporary:
            drop_table(spark, f"{quoted(database)}.{quoted(table.name)}")
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(database)} CASCADE")
