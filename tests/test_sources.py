import pytest
from pyspark.sql import functions as F

from tidemark.operators.mark import Mark
from tidemark.plans.spec import JdbcSource, TransferSpec
from tidemark.sources import jdbc, query as module
from tidemark.sources.jdbc import bounds_query, query_relation, read_options
from tidemark.sources.query import describe_source, source_frame, source_view


def test_view_lives_as_long_as_the_block(spark):
    spec = TransferSpec(alias="numbers", query="select id from range(3)")
    with source_view(spark, spec) as view:
        rows = spark.sql(f"select * from {view}")
    assert not spark.catalog.tableExists(view)
    assert rows.count() == 3


def test_filter_and_columns_reach_the_scan(spark, data):
    events = f"parquet.`{data}/events.parquet`"
    kind = spark.sql(f"select ts from {events}").schema[0].dataType
    spec = TransferSpec(
        alias="e", query=f"select event_id, ts from {events}", primary_key="ts",
        range_clause="where ts > '{max_primary_key}'")
    mark = Mark("2024-01-16 00:00:00", "2024-01-16 00:00:00", kind)
    for clause in (spec.range_clause, "where ts > :max_primary_key", lambda m: F.col("ts") > m):
        same = TransferSpec(alias="e", query=spec.query, primary_key="ts", range_clause=clause)
        plan = source_frame(spark, same, mark)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(ts,2024-01-16T00:00)" in plan, clause
        assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_describe_needs_no_job(spark):
    frame = spark.sql("select 1 as a, cast(null as decimal(5,2)) as b, raise_error('not run') as `c d`")
    got = [tuple(r) for r in describe_source(frame).collect()]
    assert got == [(1, "a", "int", False), (2, "b", "decimal(5,2)", True), (3, "c d", "void", True)]


def test_describe_counts_nulls(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = [(r.column, r.rows, r.nulls) for r in describe_source(frame, count_nulls=True).collect()]
    assert got == [("a", 3, 1), ("b", 3, 2)]


SOURCE = JdbcSource("jdbc:db://host/x", user="me", password="pw", partition_column="id", num_partitions=4)


def test_jdbc_options():
    options = read_options(SOURCE, "select * from t;", (1, 100))
    assert options == {
        "url": "jdbc:db://host/x", "user": "me", "password": "pw", "fetchsize": "10000",
        "dbtable": "(select * from t) src", "partitionColumn": "id", "lowerBound": "1", "upperBound": "100",
        "numPartitions": "4"}
    assert bounds_query(SOURCE, "select * from t") == "SELECT MIN(id) AS low, MAX(id) AS high FROM (select * from t) src"
    assert query_relation("select 1 ;") == "(select 1 ) src"


def test_jdbc_without_rows_or_ranges_is_one_read():
    assert "partitionColumn" not in read_options(SOURCE, "select 1", (None, None))
    assert "partitionColumn" not in read_options(JdbcSource("jdbc:db"), "select 1")


def test_jdbc_fetches_by_a_cursor_where_the_driver_has_to_be_told():
    assert jdbc.connection_options(JdbcSource("jdbc:mysql://h/x"))["useCursorFetch"] == "true"
    told = JdbcSource("jdbc:mysql://h/x", options={"useCursorFetch": "false"})
    assert jdbc.connection_options(told)["useCursorFetch"] == "false"
    assert "useCursorFetch" not in jdbc.connection_options(SOURCE)


def test_known_bounds_are_not_asked_for():
    class Reader:
        asked = []

        def format(self, _):
            return self

        def options(self, **options):
            self.asked.append(options)
            return self

        def load(self):
            return self

    class Session:
        read = Reader()

    jdbc.read_jdbc(Session(), JdbcSource("jdbc:db", partition_column="id", num_partitions=3, bounds=(5, 90)), "select 1")
    [options] = Reader.asked
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("5", "90", "3")


def test_jdbc_ranges_need_a_column():
    with pytest.raises(ValueError):
        JdbcSource("jdbc:db", num_partitions=4)


def test_jdbc_source_gets_the_range_in_its_query(spark, monkeypatch):
    """What the remote database is asked; no database is started for it."""
    asked = []
    monkeypatch.setattr(module, "read_jdbc", lambda s, source, text: asked.append(text) or s.range(1))
    spec = TransferSpec(
        alias="t", query="select id from t", jdbc=SOURCE, primary_key="id", range_clause="where id > {max_primary_key}")
    source_frame(spark, spec)
    source_frame(spark, spec, Mark("41", "41", spark.range(1).schema[0].dataType))
    assert asked == ["select id from t", "select id from t where id > 41"]
    assert jdbc.connection_options(JdbcSource("jdbc:db", driver="d", options={"a": "b"})) == {
        "url": "jdbc:db", "fetchsize": "10000", "a": "b", "driver": "d"}


def test_catalogue_of_a_remote_database(spark, monkeypatch):
    from tidemark.functions.typemap import map_catalogue

    rows = [("t", "id", 1, "bigint(20) unsigned", "NO"), ("t", "day", 2, "datetime(6)", "YES")]
    asked = []

    def read(session, source, text):
        asked.append((source.num_partitions, text))
        return session.createDataFrame(rows, "a string, b string, c int, d string, e string")

    monkeypatch.setattr(jdbc, "read_jdbc", read)
    mapped = map_catalogue(jdbc.read_catalogue(spark, SOURCE, "shop")).orderBy("position").collect()
    assert [(r.column, r.target_type, r.spark_type) for r in mapped] == [
        ("id", "UInt64", "decimal(20,0)"), ("day", "Nullable(DateTime)", "timestamp")]
    assert asked[0][0] == 1 and asked[0][1].endswith("WHERE table_schema = 'shop'")
    with pytest.raises(ValueError):
        jdbc.catalogue_query("shop' OR '1")


def met(keys, predicates):
    """How many rows meet each predicate; asks that every row meets just one."""
    hits = keys.select(*(F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(predicates)))
    every = sum((F.col(c) for c in hits.columns), F.lit(0))
    assert hits.where(every != 1).isEmpty()
    return list(hits.agg(*(F.sum(c) for c in hits.columns)).first())


def test_cuts_of_a_sparse_key_are_of_equal_frequency(spark):
    """Most keys lie in a millionth of the range; ranges of equal width would put them into one."""
    keys = spark.range(10_000).select(F.when(F.col("id") < 9_990, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("cut"))
    parts = met(keys, jdbc.range_predicates("cut", jdbc.key_cuts(keys, 8)))
    assert len(parts) == 8 and max(parts) <= 1.05 * min(parts)


def test_a_hot_key_has_ranges_of_its_own_and_nulls_have_one(spark):
    keys = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 4_000).when(F.col("id") % 100 != 1, F.col("id")).cast("int").alias("cut"), F.pmod(F.hash("id"), F.lit(1000)).alias("h"))
    cuts = jdbc.key_cuts(keys, 9)
    assert cuts == sorted(cuts, key=int) and cuts.count("4000") >= 3
    whole = met(keys, jdbc.range_predicates("cut", cuts))
    assert max(whole) >= 3_000  # the hot key cannot be cut by itself
    split = met(keys, jdbc.range_predicates("cut", cuts, "h"))
    assert max(split) < 1_600 and sum(split) == 9_000
    predicates = jdbc.range_predicates("cut", cuts, "h")
    assert [("cut IS NULL" in p) for p in predicates] == [True] + [False] * (len(predicates) - 1)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(20,4)", "double"])
def test_cuts_of_other_types(spark, kind):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 200).cast("int"))
    value = day.cast(kind) if kind[0] == "d" and kind == "date" or kind.startswith("timestamp") else (F.col("id") / 7).cast(kind)
    keys = spark.range(2_000).select(value.alias("cut")).unionByName(spark.sql(f"select cast(null as {kind}) as cut"))
    parts = met(keys, jdbc.range_predicates("cut", jdbc.key_cuts(keys, 4)))
    assert len(parts) == 4 and sum(parts) == 2_001 and max(parts) < 700


def test_no_keys_no_cuts_and_texts_are_refused(spark):
    assert jdbc.key_cuts(spark.sql("select cast(null as int) as cut"), 4) == []
    assert jdbc.range_predicates("k", []) == []
    with pytest.raises(TypeError, match="string"):
        jdbc.key_cuts(spark.sql("select 'a' as cut"), 4)
    with pytest.raises(ValueError):
        JdbcSource("jdbc:db", partition_column="id", num_partitions=3, bounds=(1, 2), sample="true")
    with pytest.raises(ValueError):
        JdbcSource("jdbc:db", partition_column="id", sample="true")


def test_sampled_cuts_become_the_predicates_of_the_read(spark):
    """What the reader is given; no database is started for it."""
    asked = []

    class Reader:
        def format(self, _):
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            return spark.range(1, 100).toDF("cut")

        def jdbc(self, url, table, predicates, properties):
            asked.append((url, table, predicates, properties))

    class Session:
        read = Reader()

    source = JdbcSource("jdbc:db", partition_column="id", num_partitions=2, sample="MOD(id, 10) = 0")
    jdbc.read_jdbc(Session(), source, "select * from t")
    assert asked[0]["query"] == "SELECT id AS cut FROM (select * from t) src WHERE MOD(id, 10) = 0"
    url, table, predicates, properties = asked[1]
    assert (url, table, properties) == ("jdbc:db", "(select * from t) src", {"fetchsize": "10000"})
    assert predicates == ["((id < 50) OR id IS NULL)", "(id >= 50)"]
    asked.clear()
    jdbc.read_jdbc(Session(), JdbcSource("jdbc:db", partition_column="id", cuts=("7",)), "select * from t")
    assert asked[0][2] == ["((id < 7) OR id IS NULL)", "(id >= 7)"]
