import pytest
from pyspark.sql import functions as F

from tidemark.operators.catalog import TableNames, drop_table, table_detail, table_exists
from tidemark.operators.layout import arrange
from tidemark.operators.transfer import transfer
from tidemark.plans.spec import Layout, TransferSpec


def file_ranges(table, column):
    """Rows, smallest and largest value of each file, in order."""
    files = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"))
    return [(r.rows, r.low, r.high) for r in files.orderBy("low", "high").collect()]


def loaded(spark, database, layout, frame):
    spec = TransferSpec(alias="t", database=database, frame=lambda s: frame, layout=layout)
    transfer(spark, spec)
    return spark.table(TableNames.of(spark, "t", database).live)


@pytest.fixture
def many_files(spark):
    """Keep adaptive execution from merging the small partitions of a test."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_ranged_files_do_not_overlap(spark, database, data, many_files):
    lineitem = spark.read.parquet(f"{data}/lineitem.parquet")
    table = loaded(spark, database, Layout(sort_by=("l_shipdate",), ranged=True), lineitem)
    ranges = file_ranges(table, "l_shipdate")
    assert len(ranges) > 4
    assert all(one[2] <= other[1] for one, other in zip(ranges, ranges[1:]))
    assert table.exceptAll(lineitem).count() == 0 and table.count() == lineitem.count()


def test_number_of_ranges(spark, database):
    rows = spark.range(0, 10_000, 1, 4).select(F.pmod(F.col("id") * 7919, 10_000).alias("k"))
    ranges = file_ranges(loaded(spark, database, Layout(sort_by=("k",), ranged=True, ranges=23), rows), "k")
    assert len(ranges) == 23 and sum(r[0] for r in ranges) == 10_000
    assert all(one[2] < other[1] for one, other in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("copies", [False, True])
def test_hot_value_is_cut_into_several_files(spark, database, many_files, copies):
    """A third of all rows has one key; with ``copies`` they are equal in every column."""
    rows = spark.range(0, 30_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 15_000).otherwise(F.col("id")).alias("k"),
        (F.lit(0) if copies else F.col("id")).alias("v"))
    ranges = file_ranges(loaded(spark, database, Layout(sort_by=("k",), ranged=True), rows), "k")
    assert sum(r[0] for r in ranges) == 30_000
    assert max(r[0] for r in ranges) < 10_000  # the hot key alone has 10,000 rows
    assert all(one[2] <= other[1] for one, other in zip(ranges, ranges[1:]))


def test_plain_sort_shuffles_nothing_and_sorts_each_file(spark, database):
    rows = spark.range(0, 1000, 1, 4).select(F.pmod(F.col("id") * 7919, 1000).alias("k"))
    plan = arrange(rows, Layout(sort_by=("k",)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" in plan
    table = loaded(spark, database, Layout(sort_by=("k",)), rows)
    ordered = table.groupBy(F.col("_metadata.file_path")).agg(F.collect_list("k").alias("ks"))
    assert all(r.ks == sorted(r.ks) for r in ordered.collect())


def test_no_layout_adds_nothing(spark):
    rows = spark.range(10)
    assert arrange(rows, Layout()) is rows


def test_partitions_and_spread(spark, database, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    table = loaded(spark, database, Layout(partition_by=("event_type",), sort_by=("ts",)), events)
    detail = table_detail(spark, TableNames.of(spark, "t", database).live)
    assert detail["partition_columns"] == ["event_type"]
    assert table.select(events.columns).exceptAll(events).count() == 0
    spread = loaded(spark, database, Layout(spread_by=("event_id",)), events)
    assert spread.exceptAll(events).count() == 0 and spread.count() == events.count()


@pytest.mark.parametrize("layout", [Layout(partition_by=("p",)), Layout(spread_by=("p",))])
def test_hot_partition_is_split(spark, database, layout):
    """A third of all rows has one value; several tasks write it."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 90_000, 1, 12).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("int").alias("p"))
        table = loaded(spark, database, layout, rows)
        hot = table.where("p = 0").select(F.col("_metadata.file_path").alias("f")).groupBy("f").count().collect()
        assert len(hot) > 2 and max(r["count"] for r in hot) < 20_000
        assert table.select("id", "text", "p").exceptAll(rows).count() == 0 and table.count() == 90_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_row_groups_follow_the_option(spark, database):
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(0, 200_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    loaded(spark, database, Layout(row_group_bytes=1 << 20, compression="zstd"), rows)
    folder = table_detail(spark, TableNames.of(spark, "t", database).live)["location"].removeprefix("file:")
    meta = pq.read_metadata(glob.glob(f"{folder}/*.parquet")[0])
    assert meta.num_row_groups > 1 and meta.row_group(0).column(0).compression == "ZSTD"


def test_dropping_a_table_frees_its_files(spark, database):
    import glob

    loaded(spark, database, Layout(partition_by=("p",)), spark.range(100).select("id", (F.col("id") % 3).alias("p")))
    name = TableNames.of(spark, "t", database).live
    folder = table_detail(spark, name)["location"].removeprefix("file:")
    assert glob.glob(f"{folder}/p=*/*.parquet")
    drop_table(spark, name)
    assert not table_exists(spark, name)
    assert not glob.glob(f"{folder}/p=*/*.parquet")
    drop_table(spark, name)  # no table, no error


def test_a_released_database_leaves_no_files(spark):
    import glob

    from tidemark.operators import workspace

    database = workspace.fresh_database(spark)
    folder = spark.catalog.getDatabase(database).locationUri.removeprefix("file:")
    for _ in range(2):
        loaded(spark, database, Layout(), spark.range(100))
    assert glob.glob(f"{folder}/**/*.parquet", recursive=True)
    workspace.release(spark, database)
    assert not spark.catalog.databaseExists(database)
    assert not glob.glob(f"{folder}/**/*.parquet", recursive=True)


def test_contradicting_layouts_are_refused():
    with pytest.raises(ValueError):
        Layout(ranged=True)
    with pytest.raises(ValueError):
        Layout(sort_by=("a",), ranges=4)
    with pytest.raises(ValueError):
        Layout(partition_by=("a",), spread_by=("b",))


def exchanges(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning")


def test_bucketed_targets_join_and_group_without_an_exchange(spark, database, data):
    layout = Layout(bucket_by=("o_custkey",), buckets=8, sort_by=("o_custkey",))
    orders = spark.read.parquet(f"{data}/orders.parquet")
    table = loaded(spark, database, layout, orders)
    detail = table_detail(spark, TableNames.of(spark, "t", database).live)
    assert (int(detail["num_buckets"]), detail["bucket_columns"], detail["sort_columns"]) == (8, ["o_custkey"], ["o_custkey"])
    assert table.exceptAll(orders).isEmpty() and table.count() == orders.count()
    assert exchanges(table.groupBy("o_custkey").count()) == 0
    customers = spark.read.parquet(f"{data}/customer.parquet")
    joined = table.join(customers.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    assert exchanges(joined) == 1  # of the customers
    plain = orders.join(customers.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    assert exchanges(plain) == 2 and plain.count() == joined.count()


def test_a_bucketed_target_is_appended_to_and_refreshed(spark, database):
    spec = TransferSpec(
        alias="t", database=database, query="select id as k, id % 7 as b from range(100)", primary_key="k",
        range_clause="where id > {max_primary_key}", layout=Layout(bucket_by=("b",), buckets=4))
    transfer(spark, spec)
    from dataclasses import replace
    more = replace(spec, query="select id as k, id % 7 as b from range(150)")
    assert transfer(spark, more).rows == 50 and transfer(spark, more).rows == 0
    table = spark.table(TableNames.of(spark, "t", database).live)
    counted = table.groupBy("b").count()
    assert exchanges(counted) == 0
    assert {r.b: r["count"] for r in counted.collect()} == {b: len(range(b, 150, 7)) for b in range(7)}
    assert transfer(spark, more, force_refresh=True).rows == 150


def test_a_hot_bucket_is_written_by_several_tasks(spark, database):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 6).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("v"))
        table = loaded(spark, database, Layout(bucket_by=("k",), buckets=4), rows)
    finally:
        spark.conf.unset(size)
    hot = table.where("k = 6").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(hot) > 1 and sum(r["count"] for r in hot) == 100_000
    assert table.count() == 300_000 and exchanges(table.groupBy("k").count()) == 0


def test_buckets_need_columns_and_a_number():
    for wrong in ({"bucket_by": ("a",)}, {"buckets": 4}, {"bucket_by": ("a",), "buckets": 0}, {"bucket_by": ("a",), "buckets": 2, "spread_by": ("b",)}):
        with pytest.raises(ValueError):
            Layout(**wrong)
