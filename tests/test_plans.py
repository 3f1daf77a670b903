"""Plans of the queries: what reaches the scan, what is exchanged, what must not appear."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators.steps import latest_step_status, pending_steps
from tidemark.operators.transfer import without_present
from tidemark.plans.reports import year_max_topk


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(entry.queries()) - {"table_stats", "table_sizes"}))
def test_no_python_and_no_cross_join(spark, data, key):
    plan = plan_of(entry.queries()[key](spark, data))
    for word in ("Python", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan, word


def test_topk_reads_two_columns_and_never_sorts_all(spark, data):
    plan = plan_of(year_max_topk(spark.read.parquet(f"{data}/orders.parquet"), "o_orderdate", "o_totalprice"))
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert plan.count("Exchange") == 1


def test_anti_joins_reduce_the_log_first(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = spark.range(100).select(
            F.length(F.col("id").cast("string")).cast("string").alias("alias"), F.col("id").cast("string").alias("version"))
        plan = plan_of(pending_steps(steps, steps))
        # one exchange a side: the distinct and the join share theirs
        assert plan.count("Exchange") == 2
        rows = spark.range(100).select("id", (F.col("id") * 2).alias("k"))
        plan = plan_of(without_present(rows, rows, ("id",)))
        assert plan.count("Exchange") == 2 and "LeftAnti" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_status_is_an_aggregate(spark):
    log = spark.sql("select 'a' as alias, '1' as version, current_timestamp() as timestamp, 'x' as status, 1L as seq")
    plan = plan_of(latest_step_status(log))
    assert "Window" not in plan and "partial_max_by" in plan


def test_hot_left_key_is_split(spark, tmp_path):
    """A third of the rows has one key: adaptive execution cuts its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 60_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        right = spark.range(0, 50_000, 1, 8).select(F.col("id").alias("r"), F.uuid().alias("name"))
        from tidemark.plans.reports import left_join_projection

        joined = left_join_projection(left, right, F.col("k") == F.col("r"), [F.col("v"), F.col("name")])
        joined.write.parquet(str(tmp_path / "out"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == 60_000
        joined.collect()
        assert "skew" in plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
