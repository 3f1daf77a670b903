"""The ledger of a target: its files, with the rows and the range of the key in each.

It is a small Parquet table in a hidden folder of the target, so it moves and goes with its version. A mark is then the
largest key of listed files that are still there, and only files that nobody listed yet are read, whatever the type of the key: those that
another writer added, and those of an append that a lost driver did not report.

While an append runs, a small file beside the ledger says from which mark. Unlisted files and that file together are an
append that was cut off.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators import catalog, files
from tidemark.operators.catalog import field_of, quoted
from tidemark.operators.mark import Mark, mark_texts

ENTRIES = "path string, rows bigint, column string, low string, high string"
MOST_PATHS = 10_000  # named one by one; more unlisted files are found in a scan of all
MOST_FILES = 64  # of the ledger itself; then they are merged


@dataclass(frozen=True)
class Begun:
    """An append that was begun; ``mark`` is where it started."""

    mark: Mark | None


class Ledger:
    """The ledger of a table for its key column."""

    def __init__(self, spark: SparkSession, table: str, column: str):
        self.spark = spark
        self.session = spark.newSession()  # lists files anew; several go to a task, as one column of them at most is read
        self.session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
        self.session.conf.set("spark.sql.files.maxPartitionBytes", "2g")
        self.location = catalog.table_detail(spark, table)["location"]
        self.schema = spark.table(table).schema
        self.key = field_of(self.schema, column)
        self.folder = f"{self.location}/_ledger"

    # -- an append under way -------------------------------------------------

    @property
    def _marker(self) -> str:
        return f"{self.location}/_append"

    def begin(self, mark: Mark | None) -> None:
        texts = [mark.value, mark.exact] if mark else None
        files.write_text(self.spark, self._marker, json.dumps({"column": self.key.name, "mark": texts}))

    def begun(self) -> Begun | None:
        text = files.read_text(self.spark, self._marker)
        if text is None:
            return None
        kept = json.loads(text)
        same = kept["mark"] is not None and kept["column"] == self.key.name
        return Begun(Mark(*kept["mark"], self.key.dataType) if same else None)

    def end(self) -> None:
        """List what is new, then forget that an append was under way."""
        self.add_unlisted()
        files.delete(self.spark, self._marker)

    # -- entries ---------------------------------------------------------------

    def _typed(self, text: Column) -> Column:
        if isinstance(self.key.dataType, T.TimestampType):
            return F.timestamp_micros(text.cast("long"))
        return text.cast(self.key.dataType)

    def entries(self) -> DataFrame:
        """The entries for this key; a file may have several equal ones."""
        try:
            kept = self.session.read.schema(ENTRIES).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            kept = self.session.createDataFrame([], ENTRIES)
        return kept.where(F.col("column") == self.key.name)

    def listing(self) -> DataFrame:
        """The path of every file of the table; no content is read."""
        try:
            reader = self.session.read.format("binaryFile").option("recursiveFileLookup", "true")
            return reader.load(self.location).select(F.col("_metadata.file_path").alias("path"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.session.createDataFrame([], "path string")

    def _mark(self, high: Column) -> list[Column]:
        return list(mark_texts(F.max(self._typed(high)), self.key.dataType))

    def _made(self, row) -> Mark | None:
        return None if row["value"] is None else Mark(row["value"], row["exact"], self.key.dataType)

    def top(self) -> Mark | None:
        """The largest listed key, without a look at the files."""
        return self._made(self.entries().agg(*self._mark(F.col("high"))).first())

    def state(self) -> tuple[int, Mark | None]:
        """Number of unlisted files, and the largest key of the listed ones that are there."""
        seen = self.listing().join(self.entries(), "path", "left")
        row = seen.agg(F.count_if(F.col("rows").isNull()).alias("unlisted"), *self._mark(F.col("high"))).first()
        return row["unlisted"], self._made(row)

    def unlisted(self) -> DataFrame:
        return self.listing().join(self.entries(), "path", "left_anti")

    def unlisted_rows(self) -> DataFrame | None:
        """The rows of unlisted files; no other file is opened unless they are very many. None for no files."""
        paths = [r["path"] for r in self.unlisted().limit(MOST_PATHS + 1).collect()]
        if not paths:
            return None
        reader = self.session.read.schema(self.schema).option("basePath", self.location)
        if len(paths) <= MOST_PATHS:
            return reader.parquet(*map(unquote, paths))
        rows = reader.parquet(self.location)
        file = rows["_metadata.file_path"]
        return rows.join(self.unlisted(), file == F.col("path"), "left_semi")

    def add_unlisted(self) -> None:
        """Measure the unlisted files and list them; only their key column is read."""
        rows = self.unlisted_rows()
        if rows is None:
            return
        key, kind = F.col(quoted(self.key.name)), self.key.dataType
        measured = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("rows"),
            mark_texts(F.min(key), kind)[1].alias("low"), mark_texts(F.max(key), kind)[1].alias("high"))
        found = self.unlisted().join(measured, "path", "left").select(  # a file without rows has no group
            "path", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), F.lit(self.key.name).alias("column"), "low", "high")
        found.coalesce(1).write.mode("append").parquet(self.folder)
        self._merge()

    def _merge(self) -> None:
        """Make one file of the ledger's many. Lost in between, some entries are there twice, which changes nothing."""
        former = self.session.read.schema(ENTRIES).parquet(self.folder).inputFiles()
        if len(former) <= MOST_FILES:
            return
        kept = self.session.read.schema(ENTRIES).parquet(*map(unquote, former))
        kept.join(self.listing(), "path", "left_semi").distinct().coalesce(1).write.mode("append").parquet(self.folder)
        for path in former:
            files.delete(self.spark, unquote(path))
