import time

import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalog
from tidemark.operators.catalog import TableNames
from tidemark.operators.runlog import latest_success
from tidemark.operators.workspace import fresh_folder
from tidemark.plans.spec import Layout, TransferSpec
from tidemark.streaming import append as module
from tidemark.streaming.append import progress, repeat_transfer, stream_append

SCHEMA = "id long, k long"


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of files as a stream, and a way to add to it."""
    folder = str(tmp_path / "in")

    def add(low, high):
        spark.range(low, high, 1, 1).select("id", (F.col("id") * 10).alias("k")).write.mode("append").parquet(folder)

    add(0, 5)
    return spark.readStream.schema(SCHEMA).parquet(folder), add


@pytest.fixture
def spec(database):
    return TransferSpec(
        alias="t", database=database, frame=lambda s: s.range(0), primary_key="k", row_key=("id",),
        layout=Layout(sort_by=("k",)))


def ids(spark, spec):
    return sorted(r.id for r in spark.table(TableNames.of(spark, spec.alias, spec.database).live).collect())


def once(rows, spec, checkpoint):
    query = stream_append(rows, spec, checkpoint)
    query.awaitTermination()
    return sum(p["rows"] for p in progress(query))


def test_each_call_takes_what_is_new(spark, feed, spec):
    rows, add = feed
    checkpoint = fresh_folder(spark)
    assert once(rows, spec, checkpoint) == 5
    assert once(rows, spec, checkpoint) == 0
    add(5, 8)
    assert once(rows, spec, checkpoint) == 3
    assert ids(spark, spec) == list(range(8))


@pytest.mark.parametrize("published", [0, 1, 2])
def test_a_batch_that_is_handed_out_again_is_not_doubled(spark, feed, spec, published, monkeypatch):
    """The driver is lost before, in the middle of or after the publishing of a batch."""
    rows, add = feed
    checkpoint = fresh_folder(spark)
    once(rows, spec, checkpoint)
    add(5, 8)
    real = module.append_rows

    def lost(session, a_spec, table, batch):
        if published:
            real(session, a_spec, table, batch if published == 2 else batch.where("id = 7"))
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "append_rows", lost)
        with pytest.raises(Exception, match="lost"):
            once(rows, spec, checkpoint)
    once(rows, spec, checkpoint)
    assert ids(spark, spec) == list(range(8))


def test_a_finished_batch_is_skipped(spark, feed, spec, monkeypatch):
    """The driver is lost after the batch was noted as done, before the checkpoint has it."""
    rows, add = feed
    checkpoint = fresh_folder(spark)
    once(rows, spec, checkpoint)
    add(5, 8)
    real = catalog.set_properties

    def lost(session, table, values):
        real(session, table, values)
        if any(v.endswith(":done") for v in values.values()):
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(catalog, "set_properties", lost)
        with pytest.raises(Exception, match="lost"):
            once(rows, spec, checkpoint)
    once(rows, spec, checkpoint)
    assert ids(spark, spec) == list(range(8))


def test_two_streams_into_one_table_keep_apart(spark, feed, spec):
    rows, _ = feed
    once(rows, spec, fresh_folder(spark))
    once(rows.withColumn("id", F.col("id") + 100), spec, fresh_folder(spark))
    assert ids(spark, spec) == [0, 1, 2, 3, 4, 100, 101, 102, 103, 104]


def test_a_row_key_is_needed(spark, feed, database):
    with pytest.raises(ValueError, match="row_key"):
        stream_append(feed[0], TransferSpec(alias="t", database=database, query="select 1"), "x")


def test_repeat_goes_on_after_a_failure(spark, database):
    source = f"{database}.source"
    spark.range(5).write.saveAsTable(source)
    results, errors, calls = [], [], []

    def frame(session):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("source is away")
        return session.table(source)

    spec = TransferSpec(
        alias="t", database=database, frame=frame, primary_key="id",
        range_clause=lambda mark: F.col("id") > mark, interval="PT1S")
    run_log = f"{database}.runs"
    query = repeat_transfer(
        spark, spec, fresh_folder(spark), listener=results.append, on_error=errors.append, run_log=run_log)
    try:
        deadline = time.monotonic() + 60
        while len(results) < 2 and time.monotonic() < deadline:
            time.sleep(0.2)
        spark.range(5, 8).write.insertInto(source)
        while sum(r.rows for r in results) < 8 and time.monotonic() < deadline:
            time.sleep(0.2)
        while time.monotonic() < deadline and latest_success(spark.table(run_log)).first().last_run.rows > 3:
            time.sleep(0.2)
    finally:
        query.stop()
    assert str(errors[0]) == "source is away"
    assert all("Interrupted" in str(e) for e in errors[1:])  # by the stop of the query, in a run without new rows
    assert results[0].mode == "refresh" and results[0].rows == 5
    assert [r.rows for r in results[1:] if r.rows] == [3]
    spark.catalog.refreshTable(run_log)
    logged = spark.table(run_log)
    assert logged.where("status = 'failure' and message = 'source is away'").count() == 1
    assert logged.agg(F.sum("rows")).first()[0] == 8
    assert ids(spark, spec) == list(range(8))


def test_repeat_needs_an_interval(spark, database):
    with pytest.raises(ValueError, match="interval"):
        repeat_transfer(spark, TransferSpec(alias="t", query="select 1"), "x")


def test_a_new_checkpoint_at_the_old_path(spark, feed, spec):
    rows, add = feed
    checkpoint = fresh_folder(spark)
    once(rows, spec, checkpoint)
    shutil.rmtree(checkpoint)
    add(5, 8)
    once(rows, spec, checkpoint)
    assert ids(spark, spec) == list(range(8))


def test_repeated_runs_log_statistics_and_tell_progress(spark, database):
    heard, results = [], []
    spec = TransferSpec(alias="t", database=database, frame=lambda s: s.range(5), interval="PT1S")
    run_log = f"{database}.runs"
    query = repeat_transfer(
        spark, spec, fresh_folder(spark), listener=results.append, run_log=run_log, with_stats=True, progress=heard.append)
    try:
        deadline = time.monotonic() + 60
        while (len(results) < 2 or not spark.catalog.tableExists(run_log)) and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    first = spark.table(run_log).where("status = 'success'").orderBy("started").first()
    assert first.table_stats.rows == 5 and first.table_stats.last_modified is not None
    assert heard and heard[0].alias == "t"
