"""Transfers: refresh a target whole, or append what lies above its mark."""

from __future__ import annotations

import functools
import logging
import math
import operator
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators import catalog
from tidemark.operators.catalog import TableNames, field_of, quoted
from tidemark.operators.layout import arrange
from tidemark.operators.ledger import Ledger
from tidemark.operators.mark import Mark, high_key, low_mark, mark_texts
from tidemark.operators.progress import LoadProgress, watched_load
from tidemark.plans.spec import TransferSpec
from tidemark.sources.query import source_frame, source_view

log = logging.getLogger(__name__)

REFRESH = "refresh"
INCREMENT = "increment"

_STAGED_PROPERTY = "tidemark.staged"


class OpenAppend(RuntimeError):
    """An earlier append did not report its end and cannot be completed safely."""


@dataclass(frozen=True)
class TransferResult:
    alias: str
    mode: str
    rows: int
    started: datetime
    ended: datetime
    mark: str | None = None


@dataclass(frozen=True)
class LoadState:
    """What the ledger of a table says of its last load.

    ``open`` while an append has not reported its end; ``mark`` is then where it started, else the largest listed key.
    """

    open: bool = False
    mark: Mark | None = None

    def keep(self, spark: SparkSession, table: str, column: str) -> None:
        ledger = Ledger(spark, table, column)
        if self.open:
            ledger.begin(self.mark)
        else:
            ledger.end()

    @classmethod
    def of(cls, spark: SparkSession, table: str, column: str) -> LoadState:
        ledger = Ledger(spark, table, column)
        begun = ledger.begun()
        return cls(False, ledger.top()) if begun is None else cls(True, begun.mark)


class _Watched:
    """Rows with their count and largest key, both taken while they are written.

    The metrics sit on top of the plan, so a task that is run twice counts once.
    """

    def __init__(self, df: DataFrame, column: str | None):
        self._seen = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        self._kind = None
        if column is not None:
            self._kind = field_of(df.schema, column).dataType
            metrics += mark_texts(F.max(F.col(quoted(column))), self._kind)
        self.rows = df.observe(self._seen, *metrics)

    def count(self) -> int:
        return self._seen.get["rows"]

    def top(self) -> Mark | None:
        value = self._seen.get.get("value")
        return None if value is None else Mark(value, self._seen.get["exact"], self._kind)


def write_staging(spark: SparkSession, spec: TransferSpec, names: TableNames, df: DataFrame) -> int:
    """Load the staging table from scratch and return its row count.

    It is registered before its data, so a driver lost while writing leaves nothing that the next load does not free.
    """
    catalog.drop_table(spark, names.staging)
    catalog.create_table(spark, names, df.schema, spec.layout, live=False)
    watched = _Watched(arrange(df, spec.layout).select(*map(quoted, spark.table(names.staging).columns)), None)
    watched.rows.write.insertInto(names.staging)
    if spec.incremental:
        Ledger(spark, names.staging, spec.primary_key).add_unlisted()
    catalog.set_properties(spark, names.staging, {_STAGED_PROPERTY: "complete"})
    return watched.count()


def finish_swap(spark: SparkSession, names: TableNames) -> bool:
    """Make a complete staging table live that a driver, lost between the two renames of a swap, left."""
    if catalog.table_exists(spark, names.live) or not catalog.table_exists(spark, names.previous):
        return False
    if not catalog.table_exists(spark, names.staging) or _STAGED_PROPERTY not in catalog.get_properties(spark, names.staging):
        return False
    catalog.rename_table(spark, names.staging, names.live)
    log.warning("%s: finished the swap of an earlier load", names.live)
    return True


def refresh(spark: SparkSession, spec: TransferSpec, names: TableNames) -> int:
    """Load everything next to the live table, then swap.

    Readers see the former rows until the swap, and a failed load leaves them.
    """
    with source_view(spark, spec) as view:
        rows = write_staging(spark, spec, names, spark.table(view))
    catalog.swap_in(spark, names)
    for folder in catalog.sweep(spark, names):
        log.warning("%s: freed %s, which no table had", names.live, folder)
    return rows


def append_rows(spark: SparkSession, spec: TransferSpec, table: str, df: DataFrame) -> tuple[int, Mark | None]:
    """Append to a table, by position after a check by name; returns row count and largest key."""
    target = spark.table(table).schema
    catalog.check_columns(table, target, df.schema)
    watched = _Watched(arrange(df, spec.layout).select(*map(quoted, target.names)), spec.primary_key)
    watched.rows.write.insertInto(table)
    return watched.count(), watched.top()


def without_present(df: DataFrame, present: DataFrame, row_key: tuple[str, ...]) -> DataFrame:
    """Rows whose key is not in ``present``; equal keys there are merged before the exchange."""
    keys = present.select(*(F.col(quoted(k)).alias(f"__{k}") for k in row_key)).distinct()
    same = (F.col(quoted(k)).eqNullSafe(F.col(quoted(f"__{k}"))) for k in row_key)
    return df.join(keys, functools.reduce(operator.and_, same), "left_anti")


def _digest(rows: DataFrame, columns: list[str]) -> tuple:
    """Number and contents of rows, whatever their order."""
    content = F.xxhash64(*map(quoted, columns)).cast("decimal(38,0)")
    return tuple(rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(content), F.lit(0))).first())


def _is_whole(spark: SparkSession, spec: TransferSpec, ledger: Ledger, mark: Mark | None) -> bool:
    """Whether the unlisted files hold just the rows of the source from ``mark`` to their own largest key.

    Then a cut-off append left nothing out: all it would have added up to there is published.
    """
    if spec.rescan_ties or any(isinstance(f.dataType, T.MapType) for f in ledger.schema.fields):
        return False
    published = ledger.unlisted_rows()
    top = high_key(published, ledger.key.name) if published is not None else None
    if top is None:  # files without rows
        return published is None or published.isEmpty()
    due = source_frame(spark, spec, mark).where(F.col(quoted(ledger.key.name)) <= top.literal())
    return _digest(due, ledger.schema.names) == _digest(published, ledger.schema.names)


def increment(spark: SparkSession, spec: TransferSpec, names: TableNames) -> tuple[int, Mark | None]:
    """Append the rows above the mark of the live table.

    The target is its own checkpoint: the mark is the largest key of its files, which the ledger knows. Unlisted files are
    measured first. If an append was cut off, and they hold all that it would have added up to their largest key, they are taken as they are; else a mark
    taken from them would skip rows, and the load goes on from where that append began, without rows that are present already by ``row_key``.
    """
    live = names.live
    ledger = Ledger(spark, live, spec.primary_key)
    begun = ledger.begun()
    mark = ledger.top() if spec.trust_mark and begun is None else None
    repair = False
    if mark is None:
        unlisted, mark = ledger.state()
        if unlisted and begun is not None and not _is_whole(spark, spec, ledger, begun.mark):
            if not spec.row_key:
                raise OpenAppend(f"{live}: an append was cut off; give a row_key to complete it, or refresh the table")
            repair, mark = True, begun.mark
        elif unlisted:
            ledger.add_unlisted()
            _, mark = ledger.state()
    if mark is not None and isinstance(mark.type, T.FractionalType) and math.isnan(float(mark.exact)):
        log.warning("%s: the largest %s is no number, so nothing is above it", live, spec.primary_key)
    with source_view(spark, spec, mark) as view:
        df = spark.table(view)
        if repair or spec.rescan_ties:
            spark.catalog.refreshTable(live)  # another session may have appended
            present = spark.table(live)
            # The source is not cut: its range clause may look back further than the mark.
            low = low_mark(df, spec.primary_key)
            if low is not None:
                key = F.col(quoted(spec.primary_key))
                present = present.where((key >= low.literal()) | key.isNull())
            df = without_present(df, present, spec.row_key)
        check = [*map(quoted, spark.table(live).columns)]
        catalog.check_columns(live, spark.table(live).schema, df.schema)
        if spec.look_first and df.select(*check).isEmpty():
            if repair or begun is not None:
                ledger.end()
            return 0, mark
        if not repair:
            ledger.begin(mark)
        rows, _ = append_rows(spark, spec, live, df)
    ledger.end()
    return rows, mark


def transfer(
    spark: SparkSession,
    spec: TransferSpec,
    listener: Callable[[TransferResult], None] | None = None,
    force_refresh: bool = False,
    progress: Callable[[LoadProgress], bool | None] | None = None,
    progress_seconds: float = 0.5,
) -> TransferResult:
    """Run one transfer.

    Incremental when the spec has a range clause and the target exists, a full
    refresh otherwise. ``progress`` is told of the load while it runs; if it returns False the load is
    stopped, with ``LoadStopped``, and the target stays as it was.
    """
    if progress is not None:
        with watched_load(spark, spec.alias, progress, progress_seconds):
            return transfer(spark, spec, listener, force_refresh)
    started = datetime.now(timezone.utc)
    names = TableNames.of(spark, spec.alias, spec.database)
    mark = None
    finish_swap(spark, names)
    if spec.incremental and not force_refresh and catalog.table_exists(spark, names.live):
        mode = INCREMENT
        rows, mark = increment(spark, spec, names)
    else:
        mode = REFRESH
        rows = refresh(spark, spec, names)
    result = TransferResult(
        spec.alias, mode, rows, started, datetime.now(timezone.utc), mark.value if mark else None)
    log.info("%s: %s of %s rows", spec.alias, mode, f"{rows:,}")
    if listener is not None:
        listener(result)
    return result
