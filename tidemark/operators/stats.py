"""Statistics of tables, from what is known of their files."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import literal_frame
from tidemark.functions.measures import compression_ratio
from tidemark.operators import files
from tidemark.operators.catalog import existing, table_detail
from tidemark.operators.mark import metadata_session

if TYPE_CHECKING:
    import pyarrow as pa

PARTS_SCHEMA = (
    "database string, table string, active boolean, rows bigint, modification_time timestamp, "
    "bytes bigint, primary_key_bytes_in_memory bigint, engine string"
)
COLUMNS_SCHEMA = (
    "database string, table string, column string, data_compressed_bytes bigint, data_uncompressed_bytes bigint"
)
STATS_SCHEMA = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("disk_size", T.LongType()),
    T.StructField("pk_size", T.LongType()),
    T.StructField("engine", T.StringType()),
    T.StructField("bytes_size", T.LongType()),
    T.StructField("compressed_size", T.LongType()),
    T.StructField("uncompressed_size", T.LongType()),
    T.StructField("compression_ratio", T.DoubleType()),
])


def _bound(database: str | None, table: str | None) -> Column:
    condition = F.lit(True)
    if database is not None:
        condition &= F.col("database") == database
    if table is not None:
        condition &= F.col("table") == table
    return condition


def storage_stats(
    parts: DataFrame, columns: DataFrame, database: str | None = None, table: str | None = None
) -> DataFrame:
    """Statistics per table from its parts and columns.

    Both sides are bound to the same database and table, and aggregated to a row
    per table before they are joined. A table that is missing from ``columns``
    keeps its row, without sizes. Parts are summed per engine first: sums alone
    fit a hash aggregate, and the text of the engine would make it sort all parts.
    """
    bound = _bound(database, table)
    sizes = columns.where(bound).groupBy("database", "table").agg(
        F.sum("data_compressed_bytes").alias("compressed_size"),
        F.sum("data_uncompressed_bytes").alias("uncompressed_size"),
    )
    per_engine = parts.where(F.col("active") & bound).groupBy("database", "table", "engine").agg(
        F.sum("rows").alias("rows"),
        F.max("modification_time").alias("last_modified"),
        F.sum("bytes").alias("bytes"),
        F.sum("primary_key_bytes_in_memory").alias("pk_bytes"),
    )
    stored = per_engine.groupBy("database", "table").agg(
        F.sum("rows").alias("rows"),
        F.max("last_modified").alias("last_modified"),
        F.sum("bytes").alias("disk_size"),
        F.sum("pk_bytes").alias("pk_size"),
        F.any_value("engine").alias("engine"),
        F.sum("bytes").alias("bytes_size"),
    )
    joined = sizes.join(stored, ["database", "table"], "right")
    ratio = compression_ratio(F.col("uncompressed_size"), F.col("compressed_size"))
    return joined.withColumn("compression_ratio", ratio).select(*STATS_SCHEMA.names)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def _places(spark: SparkSession, tables: Iterable[str]) -> list[tuple[str, str, str, str]]:
    """Folder, database, table and engine of each table, once."""
    details = (table_detail(spark, name) for name in existing(spark, tables))
    return list(dict.fromkeys(
        (files.same_place(spark, d["location"]), d["namespace"][-1], d["table_name"], d["provider"]) for d in details))


def _listing(spark: SparkSession, session: SparkSession, places: list[tuple[str, str, str, str]]) -> DataFrame:
    """The files of all tables, in one scan that reads no content: database, table, engine, path, time and size.

    A file belongs to each table whose folder it lies in. Paths are cut at the depths of the folders and joined with
    them, so a file is matched by equality, however many tables there are.
    """
    folders = {place for place, *_ in places if files.exists(spark, place)}  # a table that was never loaded may have none
    roots = sorted(f for f in folders if not any(f.startswith(other + "/") for other in folders))
    found = "path string, modificationTime timestamp, length bigint"
    if roots:
        reader = session.read.format("binaryFile").option("recursiveFileLookup", "true")
        listed = reader.load(roots).select("path", "modificationTime", "length")
    else:
        listed = session.createDataFrame([], found)
    depths = sorted({f.count("/") + 1 for f in folders}) or [1]
    cut = listed.select("*", F.explode(F.array(*(F.substring_index("path", "/", d) for d in depths))).alias("place"))
    known = literal_frame(session, places, T.StructType.fromDDL("place string, database string, table string, engine string"))
    return cut.join(known, "place").select(
        "database", "table", "engine", "path", F.col("modificationTime").alias("modification_time"),
        F.col("length").alias("bytes"))


def _row_count(session: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """The rows below a folder, from the footers; no row for none."""
    try:
        files = session.read.schema(schema).parquet(location)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = session.createDataFrame([], schema)
    return files.agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 0)


def file_parts(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """Storage metadata of Parquet tables.

    A table gives one row per file with its size and time, from one listing of all tables, and one row with its
    row count, which the reader takes from the footers.
    """
    session, tables = metadata_session(spark), list(tables)
    none, active = F.lit(0).cast("bigint"), F.lit(True).alias("active")
    frames = [_listing(spark, session, _places(spark, tables)).select(
        "database", "table", active, none.alias("rows"), "modification_time", "bytes",
        none.alias("primary_key_bytes_in_memory"), "engine")]
    for name in tables:
        detail = table_detail(spark, name)
        frames.append(_row_count(session, detail["location"], spark.table(name).schema).select(
            F.lit(detail["namespace"][-1]).alias("database"), F.lit(detail["table_name"]).alias("table"), active, "rows",
            F.lit(None).cast("timestamp").alias("modification_time"), none.alias("bytes"),
            none.alias("primary_key_bytes_in_memory"), F.lit(detail["provider"]).alias("engine")))
    return _union(frames)


def _footer_reader() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task that reads footers: adds rows and column sizes to a batch of files.

    It is an inner function so that it is sent to executors whole; they need
    pyarrow, but not this package.
    """

    def read(batches):
        import pyarrow
        import pyarrow.fs
        import pyarrow.parquet

        sizes = pyarrow.list_(pyarrow.struct([
            ("column", pyarrow.string()), ("compressed", pyarrow.int64()), ("uncompressed", pyarrow.int64())]))
        for batch in batches:
            rows, columns = [], []
            for path in batch.column("path").to_pylist():
                scheme, _, rest = path.partition(":")
                if scheme == "file":
                    system, inner = pyarrow.fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    # The folder of a partition value may hold any character; only the host is a URI.
                    host, _, inner = rest.lstrip("/").partition("/")
                    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
                    system, base = pyarrow.fs.FileSystem.from_uri(f"{scheme}://{host}/")
                    inner = f"{base.rstrip('/')}/{inner}"
                with system.open_input_file(inner) as handle:
                    footer = pyarrow.parquet.read_metadata(handle)
                found = {}
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        size = found.setdefault(chunk.path_in_schema.partition(".")[0], [0, 0])
                        size[0] += chunk.total_compressed_size
                        size[1] += chunk.total_uncompressed_size
                rows.append(footer.num_rows)
                columns.append([{"column": k, "compressed": a, "uncompressed": b} for k, (a, b) in found.items()])
            yield pyarrow.RecordBatch.from_arrays(
                [*batch.columns, pyarrow.array(rows, pyarrow.int64()), pyarrow.array(columns, sizes)],
                names=[*batch.schema.names, "rows", "columns"])

    return read


def _footers(listing: DataFrame) -> DataFrame:
    """Files with the rows and column sizes of their footers.

    Spark has no function for them, so tasks read the footers of the files that
    Spark lists and hands out.
    """
    sizes = T.ArrayType(T.StructType.fromDDL("column string, compressed bigint, uncompressed bigint"))
    schema = T.StructType([*listing.schema.fields]).add("rows", T.LongType()).add("columns", sizes)
    return listing.mapInArrow(_footer_reader(), schema)


def file_columns(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """Stored sizes of the columns of Parquet tables, a row for each column of each file."""
    found = _footers(_listing(spark, metadata_session(spark), _places(spark, tables)))
    return found.select("database", "table", F.explode("columns").alias("of")).select(
        "database", "table", "of.column", F.col("of.compressed").alias("data_compressed_bytes"),
        F.col("of.uncompressed").alias("data_uncompressed_bytes"))


def table_stats(spark: SparkSession, tables: Iterable[str], column_sizes: bool = True) -> DataFrame:
    """Statistics of tables of the catalogue, a row per table that holds data.

    All tables are listed in one scan, whose tasks also read rows and column sizes from the footers. Without
    ``column_sizes`` no footer is opened from Python: row counts are pushed into a reader for each table, and compressed and
    uncompressed sizes stay empty.
    """
    tables = list(tables)
    if not column_sizes:
        return storage_stats(file_parts(spark, tables), spark.createDataFrame([], COLUMNS_SCHEMA))
    found = _footers(_listing(spark, metadata_session(spark), _places(spark, tables)))

    def total(size: str) -> Column:
        of_file = F.aggregate("columns", F.lit(0).cast("bigint"), lambda sum_, column: sum_ + column[size])
        return F.nullif(F.sum(of_file), F.lit(0))  # files without a row group have no column sizes

    totals = found.groupBy("database", "table", "engine").agg(
        F.sum("rows").alias("rows"),
        F.max("modification_time").alias("last_modified"),
        F.sum("bytes").alias("disk_size"),
        F.lit(0).cast("bigint").alias("pk_size"),
        F.sum("bytes").alias("bytes_size"),
        total("compressed").alias("compressed_size"),
        total("uncompressed").alias("uncompressed_size"),
    )
    ratio = compression_ratio(F.col("uncompressed_size"), F.col("compressed_size"))
    return totals.withColumn("compression_ratio", ratio).select(*STATS_SCHEMA.names)


def table_sizes(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """Bytes on disk of each table, from one listing; an empty table has 0."""
    session, places = metadata_session(spark), _places(spark, tables)
    known = literal_frame(session, [p[1:3] for p in places], T.StructType.fromDDL("database string, table string"))
    stored = _listing(spark, session, places).groupBy("database", "table").agg(F.sum("bytes").alias("size"))
    return known.join(stored, ["database", "table"], "left").select(
        "database", "table", F.coalesce("size", F.lit(0).cast("bigint")).alias("size"))
