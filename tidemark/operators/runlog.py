"""The run log, and reports over it."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions import measures
from tidemark.functions.literals import literal_frame
from tidemark.operators.catalog import TableNames, table_exists
from tidemark.operators.progress import LoadProgress
from tidemark.operators.stats import STATS_SCHEMA, table_stats
from tidemark.operators.steps import apply_steps
from tidemark.operators.transfer import TransferResult, transfer
from tidemark.plans.spec import AFTER, BEFORE, FAILURE, SUCCESS, Step, TransferSpec

log = logging.getLogger(__name__)

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("alias", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("started", T.TimestampType()),
    T.StructField("ended", T.TimestampType()),
    T.StructField("rows", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("mark", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("table_stats", STATS_SCHEMA),
])


def run_frame(spark: SparkSession, runs: Iterable[tuple]) -> DataFrame:
    """Finished runs as one partition: a row per run."""
    return literal_frame(spark, runs, RUN_LOG_SCHEMA)


def append_log(rows: DataFrame, table: str) -> None:
    """Append to a log table, created on first use."""
    if table_exists(rows.sparkSession, table):
        rows.sparkSession.catalog.refreshTable(table)  # it may have been compacted by another session
        rows.write.insertInto(table)
    else:
        rows.write.format("parquet").saveAsTable(table)


def with_measures(runs: DataFrame) -> DataFrame:
    """Elapsed time, rate and text forms of each run."""
    return (
        runs.withColumn("elapsed_us", measures.elapsed_us(F.col("started"), F.col("ended")))
        .withColumn("rows_per_second", measures.rows_per_second(F.col("rows"), F.col("elapsed_us")))
        .withColumns({
            "started_text": measures.millisecond_text(F.col("started")),
            "rows_text": measures.number_text(F.col("rows")),
            "rate_text": measures.number_text(F.col("rows_per_second")),
        })
    )


def latest_success(runs: DataFrame) -> DataFrame:
    """The last successful run of each alias.

    An aggregate, not a window: each task first reduces its rows to one per
    alias, so that an alias with most of the log costs no more than another. Runs
    with the same times are told apart by their other columns, in the order of
    the table, so that the answer does not depend on the order of rows.
    """
    fields = [F.col(c) for c in runs.columns if c != "alias"]
    last = F.max_by(F.struct(*fields), F.struct("started", "ended", *fields))
    return runs.where(F.col("status") == SUCCESS).groupBy("alias").agg(last.alias("last_run"))


def transfer_status(aliases: DataFrame, runs: DataFrame) -> DataFrame:
    """Every alias with its last success, or NULL."""
    return aliases.select("alias").join(latest_success(runs), "alias", "left")


def run_totals(runs: DataFrame) -> DataFrame:
    """Number of runs and of copied rows."""
    return runs.agg(F.count(F.lit(1)).alias("transfers"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def spec_frame(spark: SparkSession, specs: Iterable[TransferSpec]) -> DataFrame:
    """The declared transfers, a row each."""
    rows = [(s.alias, s.database, s.primary_key, s.incremental, s.interval) for s in specs]
    return literal_frame(spark, rows, T.StructType.fromDDL(
        "alias string, database string, primary_key string, incremental boolean, interval string"))


def logged_run(
    spark: SparkSession,
    spec: TransferSpec,
    run_log: str | None = None,
    listener: Callable[[TransferResult], None] | None = None,
    with_stats: bool = False,
    progress: Callable[[LoadProgress], bool | None] | None = None,
) -> tuple[tuple, Exception | None]:
    """Run a transfer and log it; returns its row and, if it failed, the error."""
    started = datetime.now(timezone.utc)
    error = None
    try:
        result = transfer(spark, spec, listener, progress=progress)
    except Exception as failure:  # given to the caller, which decides whether to go on
        error = failure
        run = (spec.alias, None, started, datetime.now(timezone.utc), None, FAILURE, None, str(failure), None)
    else:
        found = message = None
        if with_stats:
            try:
                found = table_stats(spark, [TableNames.of(spark, spec.alias, spec.database).live]).first()
            except Exception as failure:  # the load is done all the same
                message = f"no statistics: {failure}"
                log.warning("%s: %s", spec.alias, message)
        run = (result.alias, result.mode, result.started, result.ended, result.rows, SUCCESS, result.mark, message, found)
    if run_log is not None:
        append_log(run_frame(spark, [run]), run_log)
    return run, error


def run_transfers(
    spark: SparkSession,
    specs: Iterable[TransferSpec],
    names: Iterable[str] | None = None,
    steps: Mapping[str, Iterable[Step]] | None = None,
    run_log: str | None = None,
    step_log: str | None = None,
    listener: Callable[[TransferResult], None] | None = None,
    with_stats: bool = False,
    progress: Callable[[LoadProgress], bool | None] | None = None,
) -> DataFrame:
    """Run transfers one after the other, each between its before and after steps.

    ``names`` keeps the listed aliases; without it all are run. ``progress`` hears of each load while it runs. Returns a row per
    run, which is also appended to ``run_log``. A failure is logged and ends the
    call.
    """
    wanted = None if names is None else set(names)
    specs, steps = list(specs), steps or {}
    unknown = (wanted or set()) - {spec.alias for spec in specs}
    if unknown:
        raise ValueError(f"no transfers named {', '.join(sorted(unknown))}")
    if any(steps.values()) and step_log is None:
        raise ValueError("steps need a step_log table")
    runs = []
    for spec in specs:
        if wanted is not None and spec.alias not in wanted:
            continue
        own = list(steps.get(spec.alias, ()))
        target = TableNames.of(spark, spec.alias, spec.database).live
        if own:
            apply_steps(spark, spec.alias, own, BEFORE, step_log, target)
        run, error = logged_run(spark, spec, run_log, listener, with_stats, progress)
        runs.append(run)
        if error is not None:
            raise error
        if own:
            apply_steps(spark, spec.alias, own, AFTER, step_log, target)
    log.info("completed %s transfers with %s rows", len(runs), f"{sum(r[4] for r in runs):,}")
    return run_frame(spark, runs)
