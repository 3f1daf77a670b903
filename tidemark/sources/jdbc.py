"""Remote databases as sources, through Spark's JDBC reader."""

from __future__ import annotations

from dataclasses import replace

from itertools import groupby

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.plans.spec import JdbcSource, check_name


# Connection properties without which a driver ignores the fetch size and holds the whole result in memory.
CURSOR_OPTIONS = {"jdbc:mysql:": {"useCursorFetch": "true"}}


def connection_options(source: JdbcSource) -> dict[str, str]:
    options = {"url": source.url, "fetchsize": str(source.fetch_size)}
    for kind, cursor in CURSOR_OPTIONS.items():
        if source.url.startswith(kind):
            options |= cursor
    options |= source.options
    for key in ("user", "password", "driver"):
        if getattr(source, key) is not None:
            options[key] = getattr(source, key)
    return options


def query_relation(query: str) -> str:
    """A query as a relation, so that the remote database runs it whole."""
    return f"({query.strip().rstrip(';')}) src"


def bounds_query(source: JdbcSource, query: str) -> str:
    column = source.partition_column
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {query_relation(query)}"


def read_options(source: JdbcSource, query: str, bounds: tuple | None = None) -> dict[str, str]:
    """Options of a read; with bounds it is split into key ranges.

    The bounds only place the cuts: Spark gives the first and last range what
    lies outside, and rows without a key.
    """
    options = {**connection_options(source), "dbtable": query_relation(query)}
    if bounds and bounds[0] is not None:
        options |= {
            "partitionColumn": source.partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(source.num_partitions),
        }
    return options


def catalogue_query(database: str) -> str:
    """The columns of every table of a remote database, with their full type texts."""
    return (
        "SELECT table_name, column_name, ordinal_position, column_type, is_nullable "
        f"FROM information_schema.columns WHERE table_schema = '{check_name('database', database)}'"
    )


def read_catalogue(spark: SparkSession, source: JdbcSource, database: str) -> DataFrame:
    """Catalogue rows of a remote database, for the type map."""
    rows = read_jdbc(spark, replace(source, partition_column=None, num_partitions=1), catalogue_query(database))
    return rows.toDF("table", "column", "position", "type_text", "is_nullable").select(
        "table", "column", "position", "type_text", (F.lower("is_nullable") == "yes").alias("nullable"))


def sample_query(source: JdbcSource, query: str) -> str:
    """The keys of the rows that the remote database keeps as a sample."""
    return f"SELECT {source.partition_column} AS cut FROM {query_relation(query)} WHERE {source.sample}"


def key_cuts(keys: DataFrame, ranges: int) -> list[str]:
    """The keys of a column ``cut`` at equal shares, as SQL values in ascending order; a hot one stands there more than once.

    Only numbers, dates and timestamps: Spark and a remote database may sort texts differently, and ranges between cuts
    that are out of order would lose rows. The keys are aggregated, not collected.
    """
    kind = keys.schema["cut"].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"no cuts over {kind.simpleString()}")
    shares = [i / ranges for i in range(1, ranges)]
    if isinstance(kind, T.FractionalType):
        keys = keys.where(~F.isnan(F.col("cut").cast("double")))
    found = F.percentile_approx("cut", shares, max(10_000, 100 * ranges))
    text = F.transform(found, lambda value: value.cast("string"))  # in the time zone of the session, as Spark's own ranges
    values = keys.agg(text.alias("cuts")).first().cuts or []
    return values if isinstance(kind, T.NumericType) else [f"'{value}'" for value in values]


def range_predicates(column: str, cuts: list[str], split_hot: str | None = None) -> list[str]:
    """Conditions of the ranges between cuts; each row meets just one, rows without a key the first."""
    predicates, low = [], None
    for cut, equal in groupby(cuts):
        predicates.append(f"({column} < {cut})" if low is None else f"({low} AND {column} < {cut})")
        low, shares = f"{column} >= {cut}", len(list(equal))
        if shares > 1:
            low = f"{column} > {cut}"
            parts = [f"{column} = {cut}"]
            if split_hot:
                part = f"MOD({split_hot}, {shares})"
                parts = [f"{column} = {cut} AND {part} = {i}" for i in range(1, shares)]
                parts.append(f"{column} = {cut} AND ({part} = 0 OR {split_hot} IS NULL)")
            predicates += [f"({p})" for p in parts]
    if low is not None:
        predicates.append(f"({low})")
        predicates[0] = f"({predicates[0]} OR {column} IS NULL)"
    return predicates


def read_jdbc(spark: SparkSession, source: JdbcSource, query: str) -> DataFrame:
    cuts = source.cuts
    if source.sample is not None:
        options = {**connection_options(source), "query": sample_query(source, query)}
        cuts = key_cuts(spark.read.format("jdbc").options(**options).load(), source.num_partitions)
    if cuts:
        options = connection_options(source)
        return spark.read.jdbc(
            options.pop("url"), query_relation(query), properties=options,
            predicates=range_predicates(source.partition_column, list(cuts), source.split_hot))
    if source.sample is not None or source.cuts is not None:  # no keys: one read
        return spark.read.format("jdbc").options(**read_options(source, query)).load()
    bounds = source.bounds
    if source.num_partitions > 1 and bounds is None:
        options = {**connection_options(source), "query": bounds_query(source, query)}
        bounds = tuple(spark.read.format("jdbc").options(**options).load().first())
    return spark.read.format("jdbc").options(**read_options(source, query, bounds)).load()
