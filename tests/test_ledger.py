"""The ledger of a target: marks, foreign files, cut-off appends, reruns, folders; progress of loads."""

import datetime as dt
import glob
import threading
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalog, files
from tidemark.operators import ledger as module
from tidemark.operators import transfer as transfers
from tidemark.operators.catalog import TableNames
from tidemark.operators.ledger import Ledger
from tidemark.operators.progress import LoadStopped
from tidemark.operators.transfer import INCREMENT, OpenAppend, transfer
from tidemark.plans.spec import Layout, TransferSpec


def names_of(spark, spec):
    return TableNames.of(spark, spec.alias, spec.database)


@pytest.fixture
def events(spark, database, data):
    """Events by their time, a ``timestamp_ntz``; the target holds the first half of the month."""
    source = spark.read.parquet(f"{data}/events.parquet")
    half = source.where("ts < timestamp_ntz'2024-01-16 00:00:00'")
    spec = TransferSpec(
        alias="events", database=database, primary_key="ts", range_clause=lambda mark: F.col("ts") > mark,
        frame=lambda s: source, layout=Layout(sort_by=("ts",)))
    transfer(spark, replace(spec, frame=lambda s: half))
    return spec


@pytest.fixture
def opened(monkeypatch):
    """The files whose rows a ledger reads, call by call."""
    calls, real = [], Ledger.unlisted_rows

    def watched(self):
        rows = real(self)
        calls.append([] if rows is None else rows.inputFiles())
        return rows

    monkeypatch.setattr(Ledger, "unlisted_rows", watched)
    return calls


def scan_of(frame):
    plan = frame._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):
        plan = plan.children().apply(0)
    return plan


def test_an_increment_reads_only_files_that_are_not_listed(spark, events, opened):
    live = names_of(spark, events).live
    before = set(spark.table(live).inputFiles())
    result = transfer(spark, events)
    assert result.mode == INCREMENT and result.rows == events.frame(spark).where("ts >= timestamp_ntz'2024-01-16 00:00:00'").count()
    spark.catalog.refreshTable(live)
    added = set(spark.table(live).inputFiles()) - before
    assert before and opened == [[*opened[0]]] and set(opened[0]) == added  # once, after the append, and nothing for the mark
    assert spark.table(live).exceptAll(events.frame(spark)).isEmpty()


def test_a_foreign_file_is_found_and_nothing_else_is_opened(spark, events, opened):
    transfer(spark, events)
    live, late = names_of(spark, events).live, dt.datetime(2031, 1, 1)
    before = set(spark.table(live).inputFiles())
    spark.table(live).limit(1).withColumn("ts", F.lit(late)).select(spark.table(live).columns).coalesce(1).write.insertInto(live)
    spark.catalog.refreshTable(live)
    foreign = set(spark.table(live).inputFiles()) - before
    opened.clear()
    result = transfer(spark, events)
    assert (result.rows, result.mark[:10]) == (0, "2031-01-01") and set(opened[0]) == foreign and len(opened) == 1
    opened.clear()
    assert transfer(spark, events).rows == 0 and opened == []
    scan = scan_of(spark.read.schema(spark.table(live).schema).parquet(*foreign).select("ts"))
    assert scan.nodeName().startswith("Scan")


def test_a_scan_of_unlisted_files_has_their_rows_only(spark, events):
    live = names_of(spark, events).live
    spark.table(live).limit(3).coalesce(1).write.insertInto(live)
    rows = Ledger(spark, live, "ts").unlisted_rows().select("ts")
    rows.collect()
    scan = scan_of(rows)
    assert scan.metrics().apply("numOutputRows").value() == 3 and scan.metrics().apply("numFiles").value() == 1


def test_a_file_that_is_gone_does_not_count(spark, database):
    spec = TransferSpec(
        alias="t", database=database, primary_key="id", range_clause=lambda mark: F.col("id") > mark, frame=lambda s: s.range(5))
    transfer(spark, spec)
    transfer(spark, replace(spec, frame=lambda s: s.range(0, 8, 1, 1)))
    live = names_of(spark, spec).live
    last = spark.table(live).where("id = 7").select("_metadata.file_path").first()[0]
    files.delete(spark, last)
    spark.catalog.refreshTable(live)
    assert transfer(spark, replace(spec, frame=lambda s: s.range(8))).rows == 3


def test_more_unlisted_files_than_are_named(spark, database, monkeypatch):
    monkeypatch.setattr(module, "MOST_PATHS", 2)
    table = f"{database}.t"
    spark.range(0, 40, 1, 8).selectExpr("id", "concat('a b:', id % 3, '[x]%') as part").write.partitionBy("part").saveAsTable(table)
    ledger = Ledger(spark, table, "id")
    assert ledger.state()[0] == 24 or ledger.state()[0] > 2
    ledger.add_unlisted()
    assert ledger.state() == (0, ledger.top()) and ledger.top().value == "39"
    assert ledger.entries().agg(F.sum("rows")).first()[0] == 40
    by_part = Ledger(spark, table, "part")  # a partition column as the key
    by_part.add_unlisted()
    assert by_part.top().value == "a b:2[x]%" and Ledger(spark, table, "id").top().value == "39"


def test_a_long_ledger_is_merged(spark, database, monkeypatch):
    monkeypatch.setattr(module, "MOST_FILES", 3)
    spec = TransferSpec(
        alias="t", database=database, primary_key="id", range_clause=lambda mark: F.col("id") > mark, frame=lambda s: s.range(2))
    for top in range(2, 9):
        assert transfer(spark, replace(spec, frame=lambda s, top=top: s.range(0, top, 1, 1))).mode
    ledger = Ledger(spark, names_of(spark, spec).live, "id")
    entries = ledger.entries()
    assert len(entries.inputFiles()) <= 4 and ledger.state()[0] == 0 and ledger.top().value == "7"
    assert entries.count() == entries.distinct().count() and entries.agg(F.sum("rows")).first()[0] == 8


def test_a_rerun_without_new_rows_writes_nothing(spark, events):
    transfer(spark, events)
    live = names_of(spark, events).live
    location = catalog.table_detail(spark, live)["location"].removeprefix("file:")
    properties = catalog.get_properties(spark, live)

    def state():
        return sorted((p, __import__("os").stat(p).st_mtime_ns) for p in glob.glob(f"{location}/**", recursive=True, include_hidden=True))

    before = state()
    assert transfer(spark, events).rows == 0
    assert state() == before and catalog.get_properties(spark, live) == properties


def test_an_append_without_a_look_first(spark, events):
    plain = replace(events, look_first=False)
    assert transfer(spark, plain).rows > 0
    assert [transfer(spark, plain).rows for _ in range(2)] == [0, 0]
    ledger = Ledger(spark, names_of(spark, plain).live, "ts")
    assert ledger.begun() is None and ledger.state()[0] == 0


def lose_driver(spark, spec, monkeypatch, keep=None):
    """An append whose files are published, all or those that ``keep`` takes, but whose end is not reported."""

    def lost(self):
        raise SystemExit("lost")

    real = transfers.append_rows
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "end", lost)
        if keep is not None:
            patch.setattr(transfers, "append_rows", lambda s, sp, table, df: real(s, sp, table, df.where(keep)))
        with pytest.raises(SystemExit):
            transfer(spark, spec)
    assert Ledger(spark, names_of(spark, spec).live, spec.primary_key).begun() is not None


def test_an_append_that_was_published_whole_needs_no_row_key(spark, events, monkeypatch):
    lose_driver(spark, events, monkeypatch)
    assert transfer(spark, events).rows == 0
    live = spark.table(names_of(spark, events).live)
    assert live.count() == events.frame(spark).count() and live.exceptAll(events.frame(spark)).isEmpty()
    assert Ledger(spark, names_of(spark, events).live, "ts").begun() is None


def test_an_append_that_was_published_up_to_some_key_goes_on_from_there(spark, events, monkeypatch):
    lose_driver(spark, events, monkeypatch, "ts < timestamp_ntz'2024-01-20 00:00:00'")
    assert transfer(spark, events).rows == events.frame(spark).where("ts >= timestamp_ntz'2024-01-20 00:00:00'").count()
    assert spark.table(names_of(spark, events).live).count() == events.frame(spark).count()


@pytest.mark.parametrize("keep", ["event_id % 2 = 0", "ts >= timestamp_ntz'2024-01-20 00:00:00'"])
def test_an_append_that_was_published_in_part_is_refused_or_completed(spark, events, monkeypatch, keep):
    lose_driver(spark, events, monkeypatch, keep)
    with pytest.raises(OpenAppend):
        transfer(spark, events)
    assert transfer(spark, replace(events, row_key=("event_id",))).rows > 0
    assert spark.table(names_of(spark, events).live).count() == events.frame(spark).count()
    assert transfer(spark, events).rows == 0


def test_other_rows_of_the_same_number_are_not_taken_as_whole(spark, events, monkeypatch):
    lose_driver(spark, events, monkeypatch)
    source = events.frame(spark)
    changed = replace(events, frame=lambda s: source.withColumn("value", F.col("value") + 1))
    with pytest.raises(OpenAppend):
        transfer(spark, changed)


# -- folders -----------------------------------------------------------------


def versions(spark, spec):
    base = spark.catalog.getDatabase(spec.database).locationUri
    return files.folders(spark, base, f"{spec.alias}__v_")


def test_three_refreshes_leave_two_folders(spark, database):
    spec = TransferSpec(alias="t", database=database, frame=lambda s: s.range(5))
    for _ in range(3):
        transfer(spark, spec)
    assert len(versions(spark, spec)) == 2  # live and previous
    for table in (names_of(spark, spec).live, names_of(spark, spec).previous):
        catalog.drop_table(spark, table)
    assert versions(spark, spec) == []


def test_a_driver_lost_while_writing_leaves_nothing(spark, database, monkeypatch):
    spec = TransferSpec(alias="t", database=database, frame=lambda s: s.range(5))
    transfer(spark, spec)

    def lost(*_):
        raise SystemExit("lost")

    with monkeypatch.context() as patch:
        patch.setattr(catalog, "set_properties", lost)  # after the data, before it is known to be complete
        with pytest.raises(SystemExit):
            transfer(spark, replace(spec, frame=lambda s: s.range(500)))
    assert len(versions(spark, spec)) == 2
    assert spark.table(names_of(spark, spec).live).count() == 5
    transfer(spark, spec)
    transfer(spark, spec)
    assert len(versions(spark, spec)) == 2


def test_folders_that_no_table_has_are_freed(spark, database):
    spec = TransferSpec(alias="t", database=database, frame=lambda s: s.range(5))
    transfer(spark, spec)
    base = spark.catalog.getDatabase(database).locationUri
    orphan, used, other = f"{base}/t__v_orphan", f"{base}/t__v_used", f"{base}/tt__v_orphan"
    for folder in (orphan, used, other):
        spark.range(1).write.parquet(folder)
    spark.sql(f"create table {database}.mine using parquet location '{used}'")
    transfer(spark, spec)
    assert not files.exists(spark, orphan) and files.exists(spark, used) and files.exists(spark, other)
    assert spark.table(f"{database}.mine").count() == 1


# -- progress ------------------------------------------------------------------


def slow(rows, seconds):
    def wait(batches):
        for batch in batches:
            time.sleep(seconds)
            yield batch

    return lambda s: s.range(0, rows, 1, 24).mapInPandas(wait, "id long")


def test_progress_of_a_running_load(spark, database):
    heard = []
    spec = TransferSpec(alias="t", database=database, frame=slow(48, 0.5))
    result = transfer(spark, spec, progress=heard.append, progress_seconds=0.1)
    assert result.rows == 48
    during = [p for p in heard[:-1] if p.running]
    assert len({p.done for p in during}) > 1  # it grew while tasks were running
    assert [p.done for p in heard] == sorted(p.done for p in heard) and heard[-1].done >= 24
    assert all(p.alias == "t" and p.done + p.running <= p.tasks for p in heard)
    assert [t for t in threading.enumerate() if t.name.startswith("progress of")] == []
    assert not spark.sparkContext.getJobTags()


def test_a_listener_stops_a_load(spark, database):
    spec = TransferSpec(alias="t", database=database, frame=lambda s: s.range(5))
    transfer(spark, spec)
    began = time.monotonic()
    with pytest.raises(LoadStopped):
        transfer(spark, replace(spec, frame=slow(480, 4)), progress=lambda p: p.running < 1, progress_seconds=0.1)
    assert time.monotonic() - began < 60
    assert spark.table(names_of(spark, spec).live).count() == 5
    assert transfer(spark, spec).rows == 5  # what it left behind is no hindrance
    assert len(versions(spark, spec)) == 2


def test_a_stopped_append_leaves_the_target(spark, database):
    spec = TransferSpec(
        alias="t", database=database, primary_key="id", range_clause=lambda mark: F.col("id") > mark, look_first=False, frame=lambda s: s.range(5))
    transfer(spark, spec)
    with pytest.raises(LoadStopped):
        transfer(spark, replace(spec, frame=slow(480, 4)), progress=lambda p: p.running < 8, progress_seconds=0.1)
    assert spark.table(names_of(spark, spec).live).count() == 5
    assert transfer(spark, replace(spec, frame=lambda s: s.range(9))).rows == 4


def test_a_failing_listener_stops_the_load(spark, database):
    def bad(_):
        raise KeyError("mine")

    spec = TransferSpec(alias="t", database=database, frame=slow(480, 4))
    with pytest.raises(LoadStopped) as error:
        transfer(spark, spec, progress=bad, progress_seconds=0.1)
    assert isinstance(error.value.__cause__, KeyError)
