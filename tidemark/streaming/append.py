"""Repeated transfers with Structured Streaming."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import catalog
from tidemark.operators.catalog import TableNames, quoted
from tidemark.operators.mark import low_mark
from tidemark.operators.progress import LoadProgress
from tidemark.operators.runlog import logged_run
from tidemark.operators.transfer import TransferResult, append_rows, without_present
from tidemark.plans.spec import TransferSpec, trigger_interval

log = logging.getLogger(__name__)


def _triggered(writer, interval: str | None):
    """At an interval, or once over all that is there."""
    if interval:
        return writer.trigger(processingTime=trigger_interval(interval))
    return writer.trigger(availableNow=True)


def _batch_state(spark: SparkSession, table: str, key: str) -> tuple[int, bool]:
    """The last batch that was begun, and whether it was finished."""
    value = catalog.get_properties(spark, table).get(key)
    if value is None:
        return -1, True
    batch, state = value.split(":")
    return int(batch), state == "done"


def stream_append(
    rows: DataFrame, spec: TransferSpec, checkpoint: str, query_name: str | None = None
) -> StreamingQuery:
    """Append a stream to the target of a spec, each row once.

    With the spec's ``interval`` a batch is started at that pace, one at a time;
    without one the call takes what is available and ends. The target keeps the
    number of the last batch as a property. A batch that the checkpoint hands out
    again is skipped if it was finished, and otherwise only its rows that are not
    present, by ``row_key``, are appended.
    """
    if not spec.row_key:
        raise ValueError(f"{spec.alias}: a streaming append needs a row_key")
    outer = rows.sparkSession
    names = TableNames.of(outer, spec.alias, spec.database)
    schema = rows.schema

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # The id belongs to the checkpoint: a new one, also at an old path, has another.
        key = f"tidemark.stream.{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
        if not catalog.table_exists(spark, names.live):
            catalog.create_table(spark, names, schema, spec.layout)
        last, done = _batch_state(spark, names.live, key)
        if number < last or (number == last and done):
            return
        first = last < 0 and not spark.table(names.live).isEmpty()  # a new checkpoint on an old target
        if number == last or first:
            spark.catalog.refreshTable(names.live)
            present = spark.table(names.live)
            # The first batch may hold all the target does, so its lowest key would bound nothing.
            low = low_mark(batch, spec.primary_key) if spec.primary_key and not first else None
            if low is not None:
                key_column = F.col(quoted(spec.primary_key))
                present = present.where((key_column >= low.literal()) | key_column.isNull())
            batch = without_present(batch, present, spec.row_key)
        catalog.set_properties(spark, names.live, {key: f"{number}:begun"})
        append_rows(spark, spec, names.live, batch)
        catalog.set_properties(spark, names.live, {key: f"{number}:done"})
        outer.catalog.refreshTable(names.live)  # batches run in a session of their own

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _triggered(writer, spec.interval).start()


def repeat_transfer(
    spark: SparkSession,
    spec: TransferSpec,
    checkpoint: str,
    listener: Callable[[TransferResult], None] | None = None,
    on_error: Callable[[Exception], None] | None = None,
    run_log: str | None = None,
    with_stats: bool = False,
    progress: Callable[[LoadProgress], bool | None] | None = None,
) -> StreamingQuery:
    """Repeat a transfer at the interval of its spec, until the query is stopped.

    For sources that cannot be read as a stream. The first run starts at once,
    runs never overlap, and one that fails is logged and tried again the next
    time, from the mark of the target. Every run is appended to ``run_log``, ``with_stats`` with the
    rows, sizes and last change of the target after it. ``progress`` hears of each load while it runs.
    Stopping the query interrupts a running load; what it may have published in
    part, the next one completes by the spec's ``row_key``.
    """
    if not spec.interval:
        raise ValueError(f"{spec.alias}: no interval")

    def run(_: DataFrame, number: int) -> None:
        _, error = logged_run(spark, spec, run_log, listener, with_stats, progress)
        if error is not None:
            log.error("%s: run %s failed", spec.alias, number, exc_info=error)
            if on_error is not None:
                on_error(error)

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    writer = ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _triggered(writer, spec.interval).start()


def progress(query: StreamingQuery) -> list[dict]:
    """Batch number, rows and rate of the recent batches of a query."""
    return [
        {"batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond}
        for p in query.recentProgress
    ]
