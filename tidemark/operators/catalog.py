"""Tables as the catalogue knows them: create, look up, rename, swap, drop.

Targets are external tables, each version in a folder of its own. A rename is
then a catalogue operation on every file system, also where moving a folder
would copy the data, and readers of the former version keep their files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

from tidemark.operators import files
from tidemark.plans.spec import Layout, check_name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def field_of(schema: StructType, column: str) -> StructField:
    """A column by its name, in any case."""
    for field in schema.fields:
        if field.name.lower() == column.lower():
            return field
    raise KeyError(f"no column {column} in {schema.names}")


@dataclass(frozen=True)
class TableNames:
    """The live table of an alias and the tables next to it."""

    database: str
    alias: str

    @classmethod
    def of(cls, spark: SparkSession, alias: str, database: str | None = None) -> TableNames:
        return cls(database or current_database(spark), check_name("alias", alias))

    def _name(self, suffix: str = "") -> str:
        return f"{quoted(self.database)}.{quoted(self.alias + suffix)}"

    @property
    def live(self) -> str:
        return self._name()

    @property
    def staging(self) -> str:
        return self._name("__staging")

    @property
    def previous(self) -> str:
        return self._name("__previous")


def current_database(spark: SparkSession) -> str:
    return spark.catalog.currentDatabase()


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def new_location(spark: SparkSession, names: TableNames) -> str:
    """A fresh folder below the folder of the database."""
    base = spark.catalog.getDatabase(quoted(names.database)).locationUri.rstrip("/")
    return f"{base}/{names.alias}__v_{uuid.uuid4().hex}"


def table_detail(spark: SparkSession, table: str) -> dict:
    """Location, provider, partition columns and properties of a table."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def create_table(
    spark: SparkSession, names: TableNames, schema: StructType, layout: Layout = Layout(), live: bool = True
) -> None:
    """Create an empty target table."""
    columns = schema.toNullable().toDDL()
    parts = ""
    if layout.partition_by:
        parts = f"PARTITIONED BY ({', '.join(map(quoted, layout.partition_by))})"
    if layout.bucket_by:
        parts = f"CLUSTERED BY ({', '.join(map(quoted, layout.bucket_by))}) "
        parts += f"SORTED BY ({', '.join(map(quoted, layout.sort_by))}) " if layout.sort_by else ""
        parts += f"INTO {layout.buckets} BUCKETS"
    options = layout.write_options()
    options_text = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in options.items())
    spark.sql(
        f"CREATE TABLE {names.live if live else names.staging} ({columns}) USING parquet "
        + (f"OPTIONS ({options_text}) " if options else "")
        + f"{parts} LOCATION {sql_text(new_location(spark, names))}"
    )


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table, if there is one, and free its folder, if that lies in the folder of its database.

    The files go first: lost in between, the table is still there to be dropped again.
    """
    if not table_exists(spark, table):
        return
    detail = table_detail(spark, table)
    location = detail.get("location")
    if location and detail.get("type") == "EXTERNAL":
        base = spark.catalog.getDatabase(quoted(detail["namespace"][-1])).locationUri
        if files.same_place(spark, location).startswith(files.same_place(spark, base) + "/"):
            files.delete(spark, location)
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def sweep(spark: SparkSession, names: TableNames) -> list[str]:
    """Free folders of versions of an alias that no table of the database has; returns them.

    Loads register a version before they write it, so only a driver lost between the two steps of a drop, or an older one,
    leaves such folders.
    """
    base = spark.catalog.getDatabase(quoted(names.database)).locationUri
    there = {files.same_place(spark, f): f for f in files.folders(spark, base, f"{names.alias}__v_")}

    def known(tables: Iterable[str]) -> set[str]:
        return {files.same_place(spark, table_detail(spark, t)["location"]) for t in tables if table_exists(spark, t)}

    if there.keys() <= known((names.live, names.staging, names.previous)):
        return []
    every = [f"{quoted(names.database)}.{quoted(t.name)}" for t in spark.catalog.listTables(names.database) if t.tableType != "VIEW" and not t.isTemporary]
    orphans = sorted(f for place, f in there.items() if place not in known(every))
    for folder in orphans:
        files.delete(spark, folder)
    return orphans


def swap_in(spark: SparkSession, names: TableNames) -> None:
    """Make the loaded staging table the live one.

    The former live table is kept as the previous version until the next swap.
    If the second rename fails, the former table is live again.
    """
    if not table_exists(spark, names.live):
        rename_table(spark, names.staging, names.live)
        return
    drop_table(spark, names.previous)
    rename_table(spark, names.live, names.previous)
    try:
        rename_table(spark, names.staging, names.live)
    except Exception:
        rename_table(spark, names.previous, names.live)
        raise


def set_properties(spark: SparkSession, table: str, values: dict[str, str]) -> None:
    pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def get_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


class SchemaDrift(ValueError):
    """The rows of a load do not have the columns of the table."""


def check_columns(table: str, target: StructType, source: StructType) -> None:
    """Raise unless names and types agree; the order of columns may differ."""
    have = {f.name: f.dataType.simpleString() for f in source.fields}
    want = {f.name: f.dataType.simpleString() for f in target.fields}
    if len(have) != len(source.fields):
        raise SchemaDrift(f"{table}: the source has duplicate column names {source.names}")
    if have != want:
        changed = sorted(set(have.items()) ^ set(want.items()))
        raise SchemaDrift(f"{table}: source and target columns differ in {changed}")


def existing(spark: SparkSession, tables: Iterable[str]) -> list[str]:
    missing = [t for t in tables if not table_exists(spark, t)]
    if missing:
        raise AnalysisException(f"no such tables: {missing}")
    return list(tables)
