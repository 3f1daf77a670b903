import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.runlog import (
    RUN_LOG_SCHEMA, latest_success, run_totals, run_transfers, spec_frame, transfer_status, with_measures)
from tidemark.plans.spec import AFTER, BEFORE, Step, TransferSpec

NOON = dt.datetime(2024, 1, 1, 12, 0, 0)


def run(alias, seconds, rows, status="success", length=2.0):
    started = NOON + dt.timedelta(seconds=seconds)
    return (alias, "refresh", started, started + dt.timedelta(seconds=length), rows, status, None, None, None)


def frame(spark, runs):
    return spark.createDataFrame(runs, RUN_LOG_SCHEMA)


def test_measures(spark):
    runs = [run("a", 0.5, 2_844_047, length=5.847), run("b", 0, 5, length=0), run("c", 0, 0), run("d", 0, 2_469, length=2)]
    got = {r.alias: r for r in with_measures(frame(spark, runs)).collect()}
    assert (got["a"].elapsed_us, got["a"].rows_text) == (5_847_000, "2,844,047")
    assert got["a"].started_text == "2024-01-01 12:00:00.500"
    assert got["a"].rows_per_second == pytest.approx(486_411.3, abs=0.1) and got["a"].rate_text == "486,411.32"
    assert got["b"].rows_per_second is None and got["b"].rate_text is None
    assert got["c"].rate_text == "0" and got["d"].rate_text == "1,234.5"


def test_status_keeps_the_last_success(spark):
    runs = frame(spark, [
        run("a", 0, 1), run("a", 50, 2), run("a", 90, None, "failure"), run("b", 0, None, "failure"), run("x", 0, 9)])
    aliases = spark.createDataFrame([("a",), ("b",), ("c",)], "alias string")
    got = {r.alias: r.last_run for r in transfer_status(aliases, runs).collect()}
    assert got["a"].rows == 2 and got["b"] is None and got["c"] is None and set(got) == {"a", "b", "c"}


def test_the_last_success_of_equal_times_does_not_depend_on_the_order(spark):
    runs = [run("a", 0, 1), run("a", 0, 2)]
    got = {latest_success(frame(spark, x)).first().last_run.rows for x in (runs, runs[::-1])}
    assert got == {2}


def test_latest_success_reduces_before_it_exchanges(spark):
    plan = latest_success(frame(spark, [run("a", 0, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_totals(spark):
    totals = run_totals(frame(spark, [run("a", 0, 1), run("b", 0, 41)])).first()
    assert (totals.transfers, totals.rows) == (2, 42)
    none = run_totals(frame(spark, [])).first()
    assert (none.transfers, none.rows) == (0, 0)


def specs(database):
    return [TransferSpec(alias=f"t{i}", database=database, query=f"select explode(sequence(1, {i})) as n") for i in (1, 2, 3)]


def test_names_keep_the_listed_transfers(spark, database):
    log = f"{database}.runs"
    with pytest.raises(ValueError, match="unknown"):
        run_transfers(spark, specs(database), names=["t1", "unknown"], run_log=log)
    got = run_transfers(spark, specs(database), names=["t1", "t3"], run_log=log)
    assert [(r.alias, r.rows, r.status) for r in got.orderBy("alias").collect()] == [
        ("t1", 1, "success"), ("t3", 3, "success")]
    assert not spark.catalog.tableExists(f"{database}.t2")
    assert run_transfers(spark, specs(database), run_log=log).count() == 3
    assert spark.table(log).count() == 5


def test_no_names_run_none(spark, database):
    assert run_transfers(spark, specs(database), names=[]).count() == 0


def test_a_failure_is_logged_and_ends_the_call(spark, database):
    log = f"{database}.runs"
    broken = TransferSpec(alias="broken", database=database, query="select raise_error('no') as x")
    with pytest.raises(Exception, match="no"):
        run_transfers(spark, [specs(database)[0], broken, specs(database)[1]], run_log=log)
    got = {r.alias: r for r in spark.table(log).collect()}
    assert {a: r.status for a, r in got.items()} == {"t1": "success", "broken": "failure"}
    assert got["broken"].rows is None and got["broken"].message


def test_steps_surround_the_load(spark, database):
    own = [
        Step("1", f"create table {database}.seen (n bigint) using parquet", BEFORE),
        Step("2", f"insert into {database}.seen select count(*) from identifier(:target)", AFTER),
    ]
    for _ in range(2):
        run_transfers(spark, specs(database)[2:], steps={"t3": own}, step_log=f"{database}.steps")
    assert [r.n for r in spark.table(f"{database}.seen").collect()] == [3]


def test_steps_need_a_log(spark, database):
    with pytest.raises(ValueError, match="step_log"):
        run_transfers(spark, specs(database), steps={"t1": [Step("1", "select 1")]})


def test_statistics_are_kept_with_a_run(spark, database):
    row = run_transfers(spark, specs(database)[2:], with_stats=True).first()
    assert row.table_stats.rows == 3 and row.table_stats.table == "t3" and row.table_stats.disk_size > 0


def test_a_load_without_statistics_is_a_success(spark, database, monkeypatch):
    def broken(*_):
        raise RuntimeError("no footer")

    monkeypatch.setattr("tidemark.operators.runlog.table_stats", broken)
    row = run_transfers(spark, specs(database)[2:], with_stats=True).first()
    assert (row.status, row.rows, row.table_stats, row.message) == ("success", 3, None, "no statistics: no footer")


def test_spec_frame(spark, database):
    frame = spec_frame(spark, specs(database))
    assert frame.where(F.col("alias").isin("t1", "t2")).count() == 2 and not frame.first().incremental
