"""Loads in sessions of their own: tasks that are run again, executors without the package."""

import os
import subprocess
import sys

SCRIPT = '''
import sys
from dataclasses import replace
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from tidemark import Layout, TransferSpec, transfer
from tidemark.operators.transfer import LoadState
from tidemark.operators.workspace import fresh_database

spark = (
    SparkSession.builder.master("local[4,3]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", sys.argv[1]).config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false").getOrCreate())


def fails_first(batches):
    """Hand out all rows, then fail in the first attempt of every second task."""
    yield from batches
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
        raise RuntimeError("lost")


def frame(session):
    rows = session.range(0, 40_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    return rows.mapInPandas(fails_first, "id long, k long")


for layout in (Layout(), Layout(sort_by=("k",)), Layout(sort_by=("k",), ranged=True), Layout(spread_by=("id",))):
    spec = TransferSpec(alias="t", database=fresh_database(spark), frame=frame, layout=layout, primary_key="id",
                        range_clause=lambda mark: F.col("id") > mark)
    result = transfer(spark, spec)
    live = spark.table(f"{spec.database}.t")
    got = live.agg(F.count("*"), F.count_distinct("id"), F.sum("id")).first()
    assert result.rows == 40_000, result
    assert tuple(got) == (40_000, 40_000, sum(range(40_000))), got
    assert LoadState.of(spark, f"{spec.database}.t", "id").mark.value == "39999"
    assert transfer(spark, spec).rows == 0
print("all loads whole")
'''


def test_loads_are_whole_when_tasks_are_run_again(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)], cwd=tmp_path, env={**os.environ, "PYTHONPATH": root},
        capture_output=True, text=True, timeout=600)
    assert run.returncode == 0 and "all loads whole" in run.stdout, run.stderr[-3000:]


ELSEWHERE = '''
import sys
sys.path.insert(0, sys.argv[2])  # in the driver only
from pyspark.sql import SparkSession
from tidemark import TransferSpec, table_stats, transfer
from tidemark.operators.workspace import fresh_database

spark = (
    SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", sys.argv[1]).config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false").getOrCreate())
database = fresh_database(spark)
transfer(spark, TransferSpec(alias="t", database=database, query="select id from range(100)"))
row = table_stats(spark, [f"{database}.t"]).first()
assert row.rows == 100 and row.compression_ratio > 0, row
print("statistics found")
'''


def test_executors_need_no_copy_of_the_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", ELSEWHERE, str(tmp_path), root], cwd=tmp_path, env=env,
        capture_output=True, text=True, timeout=600)
    assert run.returncode == 0 and "statistics found" in run.stdout, run.stderr[-3000:]
