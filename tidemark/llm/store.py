"""Intermediate tables in the folder that all executors see."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import files
from tidemark.operators.workspace import fresh_folder

ROW_GROUP = 32 << 20  # bytes that a task holds while it writes


def stored(df: DataFrame) -> DataFrame:
    """``df``, written as Parquet below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage, so a lost executor repeats only what came after.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark)
    df.write.option("parquet.block.size", str(ROW_GROUP)).parquet(folder)
    found = spark.read.schema(df.schema).parquet(folder)
    found.stored_in = folder
    return found


def freed(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` gave. All that is made of it must be written by now."""
    files.delete(df.sparkSession, df.stored_in)
