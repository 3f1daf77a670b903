"""Steps that are applied once, with a logged status."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import literal_frame
from tidemark.functions.measures import checksum
from tidemark.operators.catalog import table_exists
from tidemark.plans.spec import FAILURE, LIFECYCLES, START, SUCCESS, Step, ordered_steps

log = logging.getLogger(__name__)

STEP_LOG_SCHEMA = T.StructType([
    T.StructField("alias", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("lifecycle", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("elapsed", T.StringType()),
    T.StructField("checksum", T.StringType()),
    T.StructField("seq", T.LongType()),
])


class FailedStep(RuntimeError):
    """A step did not end well, in this run or an earlier one."""


class ChangedStep(RuntimeError):
    """The text of an applied step is not what was applied."""


def step_frame(spark: SparkSession, alias: str, steps: Iterable[Step]) -> DataFrame:
    """Declared steps, a row each, with the checksum of their text."""
    rows = [(alias, s.version, s.lifecycle, s.query) for s in steps]
    frame = literal_frame(
        spark, rows, T.StructType.fromDDL("alias string, version string, lifecycle string, query string"))
    return frame.withColumn("checksum", checksum(F.col("query")))


def latest_step_status(step_log: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """The latest log row of each (alias, version).

    Rows of equal time are told apart by ``seq``. Given the declared steps, it
    also says whether their text has changed since.
    """
    fields = [F.col(c) for c in step_log.columns if c not in ("alias", "version")]
    latest = (
        step_log.groupBy("alias", "version")
        .agg(F.max_by(F.struct(*fields), F.struct("timestamp", "seq")).alias("latest"))
        .select("alias", "version", "latest.*")
    )
    if steps is None:
        return latest
    declared = steps.select("alias", "version", F.col("checksum").alias("declared"))
    return latest.join(declared, ["alias", "version"], "left").select(
        *latest.columns, (F.col("declared") != F.col("checksum")).alias("checksum_changed"))


def pending_steps(steps: DataFrame, step_log: DataFrame, lifecycle: str | None = None) -> DataFrame:
    """Steps without any log row.

    The log is reduced to its distinct keys before it is exchanged, and the join
    reuses that exchange.
    """
    if lifecycle is not None:
        steps = steps.where(F.col("lifecycle") == lifecycle)
    done = step_log.select("alias", "version").distinct()
    return steps.join(done, ["alias", "version"], "left_anti")


def create_step_log(spark: SparkSession, table: str) -> None:
    if not table_exists(spark, table):
        spark.createDataFrame([], STEP_LOG_SCHEMA).write.format("parquet").saveAsTable(table)


def _append(spark: SparkSession, table: str, step: DataFrame, status: str, elapsed: str) -> None:
    """Log one step; the checksum comes from the step's row."""
    row = step.select(
        "alias", "version",
        F.lit(datetime.now(timezone.utc)).alias("timestamp"),
        "lifecycle",
        F.lit(status).alias("status"),
        F.lit(elapsed).alias("elapsed"),
        "checksum",
        F.lit(time.time_ns()).alias("seq"),
    )
    spark.catalog.refreshTable(table)  # it may have been compacted by another session
    row.write.insertInto(table)


def apply_steps(
    spark: SparkSession,
    alias: str,
    steps: Iterable[Step],
    lifecycle: str,
    log_table: str,
    target: str | None = None,
    refuse_changes: bool = False,
) -> list[str]:
    """Run the steps of a lifecycle that were not run before; returns their versions.

    Steps run in the order of their versions. One whose latest log row is a
    success is skipped. One with any other latest row stops the run, as it is not
    known what it did. A step can name the target table as
    ``IDENTIFIER(:target)``.
    """
    if lifecycle not in LIFECYCLES:
        raise ValueError(f"lifecycle must be one of {LIFECYCLES}")
    chosen = [s for s in ordered_steps(steps) if s.lifecycle == lifecycle]
    if not chosen:
        return []
    create_step_log(spark, log_table)
    declared = step_frame(spark, alias, chosen)
    own_log = spark.table(log_table).where(F.col("alias") == alias)
    known = latest_step_status(own_log, declared)
    chosen_versions = F.col("version").isin([s.version for s in chosen])
    seen = {row.version: row for row in known.where(chosen_versions).collect()}  # a row per declared step
    applied = []
    for step in chosen:
        row = seen.get(step.version)
        if row is not None:
            if row.status != SUCCESS:
                raise FailedStep(f"found a failed step for {alias}, version {step.version}")
            if refuse_changes and row.checksum_changed:
                raise ChangedStep(f"{alias}: the text of version {step.version} has changed since it was applied")
            continue
        this = declared.where(F.col("version") == step.version)
        _append(spark, log_table, this, START, "0")
        log.info("%s: running step %s (%s)", alias, step.version, lifecycle)
        began = time.monotonic()
        try:
            result = spark.sql(step.query, args={"target": target} if target else None)
            if result.columns:  # a query, not a command: it only runs when asked to
                result.write.format("noop").mode("overwrite").save()
        except Exception as error:
            _append(spark, log_table, this, FAILURE, f"{time.monotonic() - began:.3f}")
            raise FailedStep(f"step {step.version} of {alias} failed: {error}") from error
        _append(spark, log_table, this, SUCCESS, f"{time.monotonic() - began:.3f}")
        applied.append(step.version)
    return applied
