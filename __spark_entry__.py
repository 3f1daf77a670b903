"""Queries over the given tables, each through the library, with SQL to check them."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.functions import measures, typemap  # noqa: E402
from tidemark.operators import compaction, runlog, stats, steps, workspace  # noqa: E402
from tidemark.operators.catalog import TableNames  # noqa: E402
from tidemark.operators.conform import conform, rejects  # noqa: E402
from tidemark.operators.mark import high_water_mark  # noqa: E402
from tidemark.operators.transfer import transfer  # noqa: E402
from tidemark.plans import reports  # noqa: E402
from tidemark.plans.spec import AFTER, BEFORE, Layout, Step, TransferSpec  # noqa: E402
from tidemark.sources.query import describe_source, source_frame, source_view  # noqa: E402
from tidemark.streaming.append import stream_append  # noqa: E402


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_name(sf_dir: str, name: str) -> str:
    return f"parquet.`{sf_dir}/{name}.parquet`"


def _live(spark: SparkSession, spec: TransferSpec) -> DataFrame:
    return spark.table(TableNames.of(spark, spec.alias, spec.database).live)


def _enriched(sf_dir: str, database: str | None = None) -> TransferSpec:
    """Orders with their customer, sorted by date; the flagship transfer."""
    return TransferSpec(
        alias="orders_enriched",
        database=database,
        primary_key="o_orderdate",
        range_clause="WHERE o_orderdate > '{max_primary_key}'",
        query=(
            "SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus, c_name, c_mktsegment "
            f"FROM {_sql_name(sf_dir, 'orders')} LEFT JOIN {_sql_name(sf_dir, 'customer')} "
            "ON o_custkey = c_custkey"
        ),
        layout=Layout(sort_by=("o_orderdate",)),
    )


def entry(spark: SparkSession) -> DataFrame:
    """Transfer orders with their customers, then ask for the top years."""
    spec = _enriched("/root/testdata/sf0.001", workspace.fresh_database(spark))
    transfer(spark, spec)
    return reports.year_max_topk(_live(spark, spec), "o_orderdate", "o_totalprice", name="max_price")


# ---- sources -------------------------------------------------------------


def source_query(spark, sf_dir):
    spec = TransferSpec(
        alias="open_orders",
        query="SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority "
              f"FROM {_sql_name(sf_dir, 'orders')} WHERE o_orderstatus = 'O'")
    with source_view(spark, spec) as view:
        return spark.sql("SELECT * FROM IDENTIFIER(:view)", args={"view": view})


def left_join_projection(spark, sf_dir):
    customers = _load(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").alias("c")
    orders = _load(spark, sf_dir, "orders").alias("o")
    columns = [F.col(c) for c in ("o.o_orderkey", "c.c_name", "c.c_acctbal", "o.o_orderdate", "o.o_totalprice")]
    return reports.left_join_projection(orders, customers, F.col("o.o_custkey") == F.col("c.c_custkey"), columns)


def source_schema(spark, sf_dir):
    spec = TransferSpec(
        alias="building_orders",
        query="SELECT o_orderkey, o_orderdate, o_totalprice, c_nationkey, c_name "
              f"FROM {_sql_name(sf_dir, 'orders')} LEFT JOIN (SELECT * FROM {_sql_name(sf_dir, 'customer')} "
              "WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey")
    return describe_source(source_frame(spark, spec), count_nulls=True)


def bound_filter(spark, sf_dir):
    spec = TransferSpec(
        alias="returned_items", args={"flag": "R", "status": "F"},
        query="SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate "
              f"FROM {_sql_name(sf_dir, 'lineitem')} WHERE l_returnflag = :flag AND l_linestatus = :status")
    return source_frame(spark, spec)


# ---- transfers -----------------------------------------------------------


def full_refresh(spark, sf_dir):
    spec = TransferSpec(
        alias="lineitem_net", database=workspace.fresh_database(spark),
        query="SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, "
              "l_extendedprice * (1 - l_discount) AS net, l_shipdate "
              f"FROM {_sql_name(sf_dir, 'lineitem')}")
    transfer(spark, spec)
    return _live(spark, spec)


def full_refresh_replace(spark, sf_dir):
    finished = TransferSpec(
        alias="orders_by_status", database=workspace.fresh_database(spark),
        query=f"SELECT * FROM {_sql_name(sf_dir, 'orders')} WHERE o_orderstatus = 'F'")
    transfer(spark, finished)
    opened = replace(finished, query=f"SELECT * FROM {_sql_name(sf_dir, 'orders')} WHERE o_orderstatus = 'O'")
    transfer(spark, opened)
    return _live(spark, opened)


def high_water_marks(spark, sf_dir):
    spec = _enriched(sf_dir, workspace.fresh_database(spark))
    transfer(spark, spec)
    live = TableNames.of(spark, spec.alias, spec.database).live
    marks = {c: high_water_mark(spark, live, c) for c in ("o_orderkey", "o_orderdate", "o_totalprice", "c_name")}
    return spark.range(1).select(*(mark.literal().alias(f"max_{c}") for c, mark in marks.items()))


def _events(spark, sf_dir, range_clause) -> TransferSpec:
    """Events above the mark, into a target that holds the first half of the month."""
    database = workspace.fresh_database(spark)
    query = f"SELECT * FROM {_sql_name(sf_dir, 'events')}"
    half = TransferSpec(
        alias="events_copy", database=database, query=f"{query} WHERE ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    transfer(spark, half)
    return TransferSpec(
        alias="events_copy", database=database, query=query, primary_key="ts", range_clause=range_clause)


def incremental_delta(spark, sf_dir):
    spec = _events(spark, sf_dir, "WHERE ts > '{max_primary_key}'")
    mark = high_water_mark(spark, TableNames.of(spark, spec.alias, spec.database).live, spec.primary_key)
    return source_frame(spark, spec, mark)


def incremental_append(spark, sf_dir):
    spec = _events(spark, sf_dir, "WHERE ts > :max_primary_key")
    transfer(spark, spec)
    return _live(spark, spec)


def incremental_rescan(spark, sf_dir):
    database = workspace.fresh_database(spark)
    query = f"SELECT * FROM {_sql_name(sf_dir, 'orders')}"
    early = TransferSpec(
        alias="orders_copy", database=database,
        query=f"{query} WHERE o_orderdate < DATE '1998-06-01' "
              "OR (o_orderdate = DATE '1998-06-01' AND o_orderstatus = 'F')")
    transfer(spark, early)
    late = TransferSpec(
        alias="orders_copy", database=database, query=query, primary_key="o_orderdate",
        range_clause=lambda mark: F.col("o_orderdate") >= mark, row_key=("o_orderkey",), rescan_ties=True)
    transfer(spark, late)
    return _live(spark, late)


def incremental_lookback(spark, sf_dir):
    """A target that misses events of its last three days; the range clause looks that far back."""
    database = workspace.fresh_database(spark)
    query = f"SELECT * FROM {_sql_name(sf_dir, 'events')}"
    early = TransferSpec(
        alias="events_copy", database=database,
        query=f"{query} WHERE ts < TIMESTAMP_NTZ '2024-01-13 00:00:00' "
              "OR (ts < TIMESTAMP_NTZ '2024-01-16 00:00:00' AND event_type <> 'purchase')")
    transfer(spark, early)
    late = TransferSpec(
        alias="events_copy", database=database, query=query, primary_key="ts",
        range_clause=lambda mark: F.col("ts") >= mark - F.expr("INTERVAL 4 DAYS"), row_key=("event_id",), rescan_ties=True)
    transfer(spark, late)
    return _live(spark, late)


def incremental_text_key(spark, sf_dir):
    """Pages by url; the name of the key is one that Spark hides in table properties."""
    database = workspace.fresh_database(spark)
    query = f"SELECT page_id, url FROM {_sql_name(sf_dir, 'pages')}"
    first = TransferSpec(alias="pages_copy", database=database, query=f"{query} WHERE url < 'http://s'", primary_key="url")
    transfer(spark, first)
    rest = replace(first, query=query, range_clause="WHERE url > :max_primary_key")
    transfer(spark, rest)
    transfer(spark, rest)
    return _live(spark, rest)


def incremental_noop(spark, sf_dir):
    spec = _enriched(sf_dir, workspace.fresh_database(spark))
    first, second = transfer(spark, spec), transfer(spark, spec)
    return _live(spark, spec).agg(
        F.lit(first.rows).cast("bigint").alias("first_rows"),
        F.lit(second.rows).cast("bigint").alias("second_rows"),
        F.count(F.lit(1)).alias("target_rows"))


def sorted_layout(spark, sf_dir):
    spec = TransferSpec(
        alias="lineitem_by_date", database=workspace.fresh_database(spark),
        query=f"SELECT * FROM {_sql_name(sf_dir, 'lineitem')}", layout=Layout(sort_by=("l_shipdate",), ranged=True))
    transfer(spark, spec)
    return _live(spark, spec).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))


def partitioned_layout(spark, sf_dir):
    spec = TransferSpec(
        alias="events_by_type", database=workspace.fresh_database(spark),
        query=f"SELECT * FROM {_sql_name(sf_dir, 'events')}",
        layout=Layout(partition_by=("event_type",), sort_by=("ts",)))
    transfer(spark, spec)
    return _live(spark, spec)


def bucketed_layout(spark, sf_dir):
    """Orders and customers as targets bucketed by the customer, joined without an exchange of either."""
    database = workspace.fresh_database(spark)
    for name, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
        transfer(spark, TransferSpec(
            alias=name, database=database, query=f"SELECT * FROM {_sql_name(sf_dir, name)}",
            layout=Layout(bucket_by=(key,), buckets=16, sort_by=(key,))))
    orders, customers = (spark.table(TableNames.of(spark, name, database).live) for name in ("orders", "customer"))
    return orders.join(customers.hint("merge"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy(
        "o_custkey", "c_name").agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("last_order"))


def multi_transfer(spark, sf_dir):
    runs, _ = _several(spark, sf_dir)
    return runs.select("alias", "mode", "rows", "status")


def transfer_totals(spark, sf_dir):
    _, run_log = _several(spark, sf_dir)
    return runlog.run_totals(spark.table(run_log))


def _several(spark, sf_dir) -> tuple[DataFrame, str]:
    database = workspace.fresh_database(spark)
    specs = [
        TransferSpec(alias=f"{name}_copy", database=database, query=f"SELECT * FROM {_sql_name(sf_dir, name)}")
        for name in ("customer", "orders", "part")
    ]
    run_log = f"{database}.transfer_log"
    return runlog.run_transfers(spark, specs, names=["customer_copy", "orders_copy"], run_log=run_log), run_log


def year_max_topk(spark, sf_dir):
    spec = _enriched(sf_dir, workspace.fresh_database(spark))
    transfer(spark, spec)
    return reports.year_max_topk(_live(spark, spec), "o_orderdate", "o_totalprice", name="max_price")


# ---- types and rows ------------------------------------------------------


def _type_texts(spark, sf_dir) -> DataFrame:
    """A catalogue with a column for each part; the type texts follow its size and brand."""
    size = F.col("p_size")
    width = F.concat(F.lit("("), size.cast("string"), F.lit(")"))
    sign = F.when(F.col("p_type").startswith("ECONOMY"), F.lit(" unsigned")).otherwise(F.lit(""))
    brand = F.col("p_brand")
    text = (
        F.when(brand == "Brand#1", F.concat(F.lit("INT"), width, sign))
        .when(brand == "Brand#2", F.concat(F.lit("bigint"), width, sign))
        .when(brand == "Brand#3", F.concat(F.lit("decimal ("), size.cast("string"), F.lit(", 6 )"), sign))
        .when(brand == "Brand#4", F.concat(F.lit("bit"), width))
        .when(brand == "Brand#5", F.when(size > 25, F.lit("tinyint")).otherwise(F.concat(F.lit("tinyint"), width, sign)))
        .when(size > 40, F.lit("smallint"))
        .when(size > 30, F.concat(F.lit("datetime"), F.lit("(6)")))
        .when(size > 20, F.lit("point"))
        .when(size > 10, F.concat(F.lit("enum('"), F.col("p_name"), F.lit("','print','update')")))
        .otherwise(F.lit("double"))
    )
    return _load(spark, sf_dir, "part").select(
        "p_partkey", text.alias("type_text"), (F.col("p_retailprice") > 1000).alias("nullable"))


def type_map(spark, sf_dir):
    return typemap.map_catalogue(_type_texts(spark, sf_dir))


# The source types of lineitem for the conform queries.
_LINEITEM_TYPES = [
    ("l_orderkey", "bigint(20)", False),
    ("l_partkey", "int(10) unsigned", False),
    ("l_suppkey", "int(11)", False),
    ("l_linenumber", "tinyint", False),
    ("l_quantity", "decimal(12,2)", True),
    ("l_extendedprice", "decimal(15,2)", True),
    ("l_discount", "decimal(4,2)", True),
    ("l_tax", "decimal(4,2)", True),
    ("l_returnflag", "char(1)", True),
    ("l_linestatus", "char(1)", True),
    ("l_shipdate", "date", True),
]


def conform_schema(spark, sf_dir):
    schema = typemap.mapped_schema(spark, _LINEITEM_TYPES)
    return conform(_load(spark, sf_dir, "lineitem"), schema)


def conform_rejects(spark, sf_dir):
    schema = typemap.mapped_schema(spark, [("o_orderkey", "smallint", False), ("o_totalprice", "decimal(7,2)", True)])
    refused = rejects(_load(spark, sf_dir, "orders"), schema)
    return refused.select("o_orderkey", "o_totalprice", F.concat_ws(",", "rejected").alias("rejected"))


# ---- steps ---------------------------------------------------------------


def latest_step_status(spark, sf_dir):
    log = _load(spark, sf_dir, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("alias"),
        F.col("event_type").alias("version"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("value") > 10, "success").otherwise("start").alias("status"),
        F.col("props").alias("elapsed"),
        F.col("event_id").alias("seq"))
    return steps.latest_step_status(log)


def pending_steps(spark, sf_dir):
    def named(key):
        version = F.col(key).cast("string")
        return F.concat(F.lit("digits_"), F.length(version).cast("string")).alias("alias"), version.alias("version")

    declared = _load(spark, sf_dir, "orders").select(
        *named("o_orderkey"), F.when(F.col("o_orderstatus") == "F", AFTER).otherwise(BEFORE).alias("lifecycle"))
    done = _load(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(*named("l_orderkey"))
    return steps.pending_steps(declared, done, BEFORE)


def apply_once_steps(spark, sf_dir):
    """Steps around a load, all of it twice; each step must leave its rows once."""
    database = workspace.fresh_database(spark)
    orders = _sql_name(sf_dir, "orders")
    spec = TransferSpec(
        alias="late_orders", database=database,
        query=f"SELECT * FROM {orders} WHERE o_orderdate >= DATE '1998-01-01'")
    summary = f"{database}.status_summary"
    own = [
        Step("1", f"CREATE TABLE {summary} (source STRING, status STRING, orders BIGINT) USING parquet", BEFORE),
        Step("2", f"INSERT INTO {summary} SELECT 'all', o_orderstatus, count(*) FROM {orders} GROUP BY 2", BEFORE),
        Step("10", f"INSERT INTO {summary} SELECT 'late', o_orderstatus, count(*) "
                   "FROM IDENTIFIER(:target) GROUP BY 2", AFTER),
    ]
    step_log = f"{database}.step_log"
    for _ in range(2):
        runlog.run_transfers(spark, [spec], steps={spec.alias: own}, step_log=step_log)
    log = spark.table(step_log)
    rows = spark.table(summary).select("source", "status", "orders")
    applied = (
        steps.latest_step_status(log).groupBy("status").agg(F.count(F.lit(1)).alias("orders"))
        .select(F.lit("steps").alias("source"), "status", "orders"))
    return rows.unionByName(applied)


def step_checksum(spark, sf_dir):
    return _load(spark, sf_dir, "documents").select("doc_id", measures.checksum(F.col("text")).alias("checksum"))


# ---- run log -------------------------------------------------------------


def transfer_run_log(spark, sf_dir):
    """The events of a user on a day as one run."""
    runs = _load(spark, sf_dir, "events").groupBy(
        F.col("user_id").cast("string").alias("alias"), F.to_date("ts").alias("day")
    ).agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"),
        F.sum(F.round(F.col("value") * 1000).cast("bigint")).alias("rows"))
    return runlog.with_measures(runs)


def transfer_status(spark, sf_dir):
    events = _load(spark, sf_dir, "events")
    alias = F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("alias")
    runs = events.select(
        alias, F.col("ts").alias("started"), F.col("ts").alias("ended"), F.col("event_id").alias("rows"),
        F.when(F.col("event_type") == "purchase", "success").otherwise("failure").alias("status"))
    status = runlog.transfer_status(events.select(alias).distinct(), runs)
    return status.select("alias", F.col("last_run.started").alias("started"), F.col("last_run.rows").alias("rows"))


def compacted_log(spark, sf_dir):
    """The events as log rows, in many files, merged after each of three appends; totals of the log."""
    log = f"{workspace.fresh_database(spark)}.event_log"
    events = _load(spark, sf_dir, "events")
    for third in range(3):
        rows = events.where(F.pmod("user_id", F.lit(3)) == third).repartition(16)
        runlog.append_log(rows.select(F.col("event_type").alias("alias"), F.col("event_id").alias("rows"), F.col("ts").alias("ended")), log)
        compaction.compact_log(spark, log, least_files=8)
    return spark.table(log).groupBy("alias").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows").alias("rows"), F.max("ended").alias("ended"))


# ---- statistics ----------------------------------------------------------


def stats_join(spark, sf_dir):
    """Line items as parts of the tables of their supplier, suppliers in credit as columns."""
    parts = _load(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("database"),
        F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("table"),
        (F.col("l_returnflag") != "R").alias("active"),
        F.col("l_quantity").cast("bigint").alias("rows"),
        F.col("l_shipdate").alias("modification_time"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("bytes"),
        F.col("l_linenumber").cast("bigint").alias("primary_key_bytes_in_memory"),
        F.concat(F.lit("engine_"), F.col("l_suppkey").cast("string")).alias("engine"))
    columns = _load(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0).select(
        F.lit("O").alias("database"),
        F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")).alias("table"),
        F.col("s_nationkey").cast("bigint").alias("data_compressed_bytes"),
        F.round(F.col("s_acctbal") * 100).cast("bigint").alias("data_uncompressed_bytes"))
    return stats.storage_stats(parts, columns, database="O")


def _copies(spark, sf_dir) -> list[str]:
    database = workspace.fresh_database(spark)
    names = []
    for name in ("customer", "events", "lineitem", "orders"):
        spec = TransferSpec(alias=name, database=database, query=f"SELECT * FROM {_sql_name(sf_dir, name)}")
        transfer(spark, spec)
        names.append(TableNames.of(spark, name, database).live)
    return names


def table_stats(spark, sf_dir):
    return stats.table_stats(spark, _copies(spark, sf_dir)).select(
        "table", "rows", "engine", (F.col("disk_size") > F.col("compressed_size")).alias("stored"),
        (F.col("compression_ratio") > 0).alias("has_ratio"))


def table_sizes(spark, sf_dir):
    names = _copies(spark, sf_dir)
    known = stats.table_stats(spark, names, column_sizes=False).select("table", "disk_size")
    return stats.table_sizes(spark, names).join(known, "table").select(
        "table", (F.col("size") > 0).alias("stored"), (F.col("size") == F.col("disk_size")).alias("same_as_stats"))


# ---- streams -------------------------------------------------------------


def stream_append_events(spark, sf_dir):
    spec = TransferSpec(
        alias="events_stream", database=workspace.fresh_database(spark), frame=lambda s: _load(s, sf_dir, "events"),
        primary_key="event_id", row_key=("event_id",))
    schema = _load(spark, sf_dir, "events").schema
    # A pattern, as the table may be one file, which a stream does not take by its name.
    # Batches are bounded, so that one which fails does not start over with everything.
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", 4 << 40)
    rows = reader.parquet(f"{sf_dir}/events.parque*")
    checkpoint = workspace.fresh_folder(spark)
    for _ in range(2):  # the second call finds nothing new
        stream_append(rows, spec, checkpoint).awaitTermination()
    return _live(spark, spec)


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "source_query": source_query,
        "left_join_projection": left_join_projection,
        "source_schema": source_schema,
        "bound_filter": bound_filter,
        "full_refresh": full_refresh,
        "full_refresh_replace": full_refresh_replace,
        "high_water_mark": high_water_marks,
        "incremental_delta": incremental_delta,
        "incremental_append": incremental_append,
        "incremental_rescan": incremental_rescan,
        "incremental_lookback": incremental_lookback,
        "incremental_text_key": incremental_text_key,
        "incremental_noop": incremental_noop,
        "sorted_layout": sorted_layout,
        "partitioned_layout": partitioned_layout,
        "bucketed_layout": bucketed_layout,
        "multi_transfer": multi_transfer,
        "transfer_totals": transfer_totals,
        "year_max_topk": year_max_topk,
        "type_map": type_map,
        "conform_schema": conform_schema,
        "conform_rejects": conform_rejects,
        "latest_step_status": latest_step_status,
        "pending_steps": pending_steps,
        "apply_once_steps": apply_once_steps,
        "step_checksum": step_checksum,
        "transfer_run_log": transfer_run_log,
        "transfer_status": transfer_status,
        "compacted_log": compacted_log,
        "stats_join": stats_join,
        "table_stats": table_stats,
        "table_sizes": table_sizes,
        "stream_append": stream_append_events,
    }


def _corpus():
    """The queries for training data and the pipeline over them, if their subpackage is there."""
    try:
        import corpus_pipeline
        from tidemark.llm import queries as corpus_queries
    except ModuleNotFoundError as missing:
        if missing.name in ("corpus_pipeline", "tidemark.llm"):
            return None, None
        raise
    return corpus_queries, corpus_pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    corpus, pipeline = _corpus()
    return _own_queries() | ({**corpus.queries(), "pipeline": pipeline.run} if corpus else {})


def oracle_sql() -> dict[str, str]:
    """DuckDB statements of the same results, over views of the given tables."""
    corpus, pipeline = _corpus()
    if not corpus:
        return _own_oracle_sql()
    return _own_oracle_sql() | corpus.oracle_sql() | ({"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {})


def _own_oracle_sql() -> dict[str, str]:
    building = "(SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c"
    described = f"(SELECT * FROM orders LEFT JOIN {building} ON o_custkey = c_custkey)"
    schema_rows = " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS \"position\", '{name}' AS \"column\", '{kind}' AS type, true AS nullable, "
        f"count(*) AS rows, count(*) FILTER (WHERE {name} IS NULL) AS nulls FROM {described}"
        for i, (name, kind) in enumerate([
            ("o_orderkey", "bigint"), ("o_orderdate", "timestamp_ntz"), ("o_totalprice", "double"),
            ("c_nationkey", "int"), ("c_name", "string")], start=1))
    years = (
        "SELECT year(o_orderdate)::INTEGER AS year, max(o_totalprice) AS max_price FROM orders "
        "GROUP BY 1 ORDER BY max_price DESC, year LIMIT 10")
    return {
        "source_query":
            "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders "
            "WHERE o_orderstatus = 'O'",
        "left_join_projection":
            f"SELECT o_orderkey, c_name, c_acctbal, o_orderdate, o_totalprice FROM orders "
            f"LEFT JOIN {building} ON o_custkey = c_custkey",
        "source_schema": schema_rows,
        "bound_filter":
            "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem "
            "WHERE l_returnflag = 'R' AND l_linestatus = 'F'",
        "full_refresh":
            "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice * (1 - l_discount) AS net, "
            "l_shipdate FROM lineitem",
        "full_refresh_replace": "SELECT * FROM orders WHERE o_orderstatus = 'O'",
        "high_water_mark":
            "SELECT max(o_orderkey) AS max_o_orderkey, max(o_orderdate) AS max_o_orderdate, "
            "max(o_totalprice) AS max_o_totalprice, max(c_name) AS max_c_name "
            "FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
        "incremental_delta":
            "SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')",
        "incremental_append": "SELECT * FROM events",
        "incremental_rescan": "SELECT * FROM orders",
        "incremental_lookback": "SELECT * FROM events",
        "incremental_text_key": "SELECT page_id, url FROM pages",
        "incremental_noop":
            "SELECT count(*) AS first_rows, "
            "count(*) FILTER (WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders)) AS second_rows, "
            "count(*) AS target_rows FROM orders",
        "sorted_layout":
            "SELECT l_returnflag, count(*) AS rows, min(l_shipdate) AS first, max(l_shipdate) AS last "
            "FROM lineitem GROUP BY l_returnflag",
        "partitioned_layout": "SELECT * FROM events",
        "bucketed_layout":
            "SELECT o_custkey, c_name, count(*) AS orders, max(o_orderdate) AS last_order "
            "FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
        "compacted_log":
            "SELECT event_type AS alias, count(*) AS runs, sum(event_id)::BIGINT AS rows, max(ts) AS ended FROM events GROUP BY 1",
        "multi_transfer":
            "SELECT 'customer_copy' AS alias, 'refresh' AS mode, count(*) AS rows, 'success' AS status FROM customer "
            "UNION ALL SELECT 'orders_copy', 'refresh', count(*), 'success' FROM orders",
        "transfer_totals":
            "SELECT count(*) AS transfers, sum(n)::BIGINT AS rows FROM "
            "(SELECT count(*) AS n FROM customer UNION ALL SELECT count(*) FROM orders)",
        "year_max_topk": years,
        "type_map": _TYPE_MAP_SQL,
        "conform_schema":
            "SELECT l_orderkey, l_partkey::BIGINT AS l_partkey, l_suppkey::INTEGER AS l_suppkey, "
            "l_linenumber::TINYINT AS l_linenumber, l_quantity::DECIMAL(12,2) AS l_quantity, "
            "l_extendedprice::DECIMAL(15,2) AS l_extendedprice, l_discount::DECIMAL(4,2) AS l_discount, "
            "l_tax::DECIMAL(4,2) AS l_tax, l_returnflag, l_linestatus, l_shipdate::DATE AS l_shipdate FROM lineitem",
        "conform_rejects":
            "SELECT o_orderkey, o_totalprice, concat_ws(',', "
            "CASE WHEN o_orderkey > 32767 THEN 'o_orderkey' END, "
            "CASE WHEN round(o_totalprice, 2) > 99999.99 THEN 'o_totalprice' END) AS rejected FROM orders "
            "WHERE o_orderkey > 32767 OR round(o_totalprice, 2) > 99999.99",
        "latest_step_status":
            "SELECT 'user_' || user_id AS alias, event_type AS version, ts AS timestamp, "
            "CASE WHEN value > 10 THEN 'success' ELSE 'start' END AS status, props AS elapsed, event_id AS seq "
            "FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
        "pending_steps":
            "SELECT 'digits_' || length(o_orderkey::VARCHAR) AS alias, o_orderkey::VARCHAR AS version, 'before' AS lifecycle FROM orders "
            "WHERE o_orderstatus <> 'F' AND NOT EXISTS "
            "(SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o_orderkey)",
        "apply_once_steps":
            "SELECT 'all' AS source, o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 2 "
            "UNION ALL SELECT 'late', o_orderstatus, count(*) FROM orders WHERE o_orderdate >= DATE '1998-01-01' "
            "GROUP BY 2 UNION ALL SELECT 'steps', 'success', 3",
        "step_checksum": _CHECKSUM_SQL,
        "transfer_run_log":
            "WITH runs AS (SELECT user_id::VARCHAR AS alias, ts::DATE AS day, min(ts) AS started, max(ts) AS ended, "
            "sum(round(value * 1000)::BIGINT)::BIGINT AS rows FROM events GROUP BY 1, 2), "
            "timed AS (SELECT *, epoch_us(ended) - epoch_us(started) AS elapsed_us FROM runs), "
            "rated AS (SELECT *, CASE WHEN elapsed_us > 0 THEN rows * 1000000.0::DOUBLE / elapsed_us END "
            "AS rows_per_second FROM timed) "
            "SELECT *, strftime(started, '%Y-%m-%d %H:%M:%S.%g') AS started_text, format('{:,}', rows) AS rows_text, "
            "CASE WHEN rows_per_second IS NOT NULL THEN "
            "regexp_replace(format('{:,.2f}', rows_per_second), '\\.?0+$', '') END AS rate_text FROM rated",
        "transfer_status":
            "SELECT 'user_' || user_id AS alias, max(ts) FILTER (WHERE event_type = 'purchase') AS started, "
            "arg_max(event_id, ts) FILTER (WHERE event_type = 'purchase') AS rows FROM events GROUP BY user_id",
        "stats_join":
            "SELECT 'O' AS \"database\", p.\"table\", rows, last_modified, disk_size, pk_size, engine, "
            "disk_size AS bytes_size, compressed_size, uncompressed_size, "
            "CASE WHEN compressed_size > 0 THEN uncompressed_size::DOUBLE / compressed_size END AS compression_ratio "
            "FROM (SELECT 'supplier_' || s_suppkey AS \"table\", sum(s_nationkey)::BIGINT AS compressed_size, "
            "sum(round(s_acctbal * 100)::BIGINT)::BIGINT AS uncompressed_size FROM supplier WHERE s_acctbal > 0 "
            "GROUP BY 1) c RIGHT JOIN (SELECT 'supplier_' || l_suppkey AS \"table\", "
            "sum(l_quantity::BIGINT)::BIGINT AS rows, max(l_shipdate) AS last_modified, "
            "sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS disk_size, sum(l_linenumber)::BIGINT AS pk_size, "
            "any_value('engine_' || l_suppkey) AS engine "
            "FROM lineitem WHERE l_returnflag <> 'R' AND l_linestatus = 'O' GROUP BY 1) p ON c.\"table\" = p.\"table\"",
        "table_stats": " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS rows, 'parquet' AS engine, true AS stored, true AS has_ratio FROM {t}"
            for t in ("customer", "events", "lineitem", "orders")),
        "table_sizes": " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) > 0 AS stored, true AS same_as_stats FROM {t}"
            for t in ("customer", "events", "lineitem", "orders")),
        "stream_append": "SELECT * FROM events",
    }


# The type texts of the type_map query, and what each must give.
_TYPE_MAP_SQL = """
WITH texts AS (
  SELECT p_partkey, p_size, p_brand, p_type LIKE 'ECONOMY%' AS economy, p_retailprice > 1000 AS nullable,
    CASE WHEN p_type LIKE 'ECONOMY%' THEN ' unsigned' ELSE '' END AS sign, p_name
  FROM part
), typed AS (
  SELECT p_partkey, nullable,
    CASE
      WHEN p_brand = 'Brand#1' THEN 'INT(' || p_size || ')' || sign
      WHEN p_brand = 'Brand#2' THEN 'bigint(' || p_size || ')' || sign
      WHEN p_brand = 'Brand#3' THEN 'decimal (' || p_size || ', 6 )' || sign
      WHEN p_brand = 'Brand#4' THEN 'bit(' || p_size || ')'
      WHEN p_brand = 'Brand#5' THEN CASE WHEN p_size > 25 THEN 'tinyint' ELSE 'tinyint(' || p_size || ')' || sign END
      WHEN p_size > 40 THEN 'smallint'
      WHEN p_size > 30 THEN 'datetime(6)'
      WHEN p_size > 20 THEN 'point'
      WHEN p_size > 10 THEN 'enum(''' || p_name || ''',''print'',''update'')'
      ELSE 'double'
    END AS type_text,
    CASE
      WHEN p_brand = 'Brand#1' THEN CASE WHEN economy THEN 'UInt32' ELSE 'Int32' END
      WHEN p_brand = 'Brand#2' THEN CASE WHEN economy THEN 'UInt64' ELSE 'Int64' END
      WHEN p_brand = 'Brand#3' THEN 'Decimal(' || p_size || ',6)'
      WHEN p_brand = 'Brand#4' THEN CASE WHEN p_size = 1 THEN 'UInt8' ELSE 'UInt64' END
      WHEN p_brand = 'Brand#5' THEN
        CASE WHEN p_size > 25 THEN 'Int8' WHEN economy THEN 'UInt32' ELSE 'Int32' END
      WHEN p_size > 40 THEN 'Int16'
      WHEN p_size > 30 THEN 'DateTime'
      WHEN p_size > 10 THEN 'String'
      ELSE 'Float64'
    END AS name,
    CASE
      WHEN p_brand = 'Brand#1' THEN CASE WHEN economy THEN 'bigint' ELSE 'int' END
      WHEN p_brand = 'Brand#2' THEN CASE WHEN economy THEN 'decimal(20,0)' ELSE 'bigint' END
      WHEN p_brand = 'Brand#3' THEN CASE WHEN p_size BETWEEN 6 AND 38 THEN 'decimal(' || p_size || ',6)' END
      WHEN p_brand = 'Brand#4' THEN
        CASE WHEN p_size = 1 THEN 'smallint' WHEN p_size < 64 THEN 'bigint' ELSE 'decimal(20,0)' END
      WHEN p_brand = 'Brand#5' THEN
        CASE WHEN p_size > 25 THEN 'tinyint' WHEN economy THEN 'bigint' ELSE 'int' END
      WHEN p_size > 40 THEN 'smallint'
      WHEN p_size > 30 THEN 'timestamp'
      WHEN p_size > 10 THEN 'string'
      ELSE 'double'
    END AS spark_type,
    CASE WHEN p_brand = 'Brand#3' AND p_size > 38 THEN 'decimal precision above 38'
         WHEN p_brand = 'Brand#3' AND p_size < 6 THEN 'decimal scale above precision' END AS problem
  FROM texts
)
SELECT p_partkey, type_text, nullable,
  CASE WHEN nullable THEN 'Nullable(' || name || ')' ELSE name END AS target_type, spark_type, problem
FROM typed
"""

# CRC32 from its definition: the table of the reflected polynomial, then the bytes of each text.
_CHECKSUM_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries
)
SELECT doc_id, xor(list_reduce(
    list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295)::VARCHAR AS checksum
FROM documents, crc
"""
