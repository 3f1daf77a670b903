"""Declarations of transfers, layouts and steps. Nothing in here runs a job."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

# The marker of the high-water mark in a range clause, and the
# words used in the step log.
MARK_TEXT = "{max_primary_key}"
MARK_PARAMETER = "max_primary_key"
BEFORE = "before"
AFTER = "after"
LIFECYCLES = (BEFORE, AFTER)
START = "start"
SUCCESS = "success"
FAILURE = "failure"
STATUSES = (START, SUCCESS, FAILURE)

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_DURATION = re.compile(r"P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?", re.IGNORECASE)


def check_name(kind: str, name: str) -> str:
    if not _NAME.fullmatch(name or ""):
        raise ValueError(f"{kind} {name!r} must be letters, digits and underscores")
    return name


@dataclass(frozen=True)
class Layout:
    """How the files of a target are arranged.

    ``sort_by`` sorts the rows of each file, so that the min/max values of its row
    groups prune range reads; this needs no shuffle. ``ranged`` also gives every
    file a range of its own, at the price of a shuffle and a sampling pass over
    the source; ``ranges`` is their number, which adaptive execution may lower but
    not raise, so give it for large sources (``spark.sql.shuffle.partitions``
    else). ``partition_by`` makes directories. ``spread_by`` shuffles by the
    given columns before writing, for sources that come in few splits.
    ``bucket_by`` deals rows into ``buckets`` by a hash of columns, sorted by ``sort_by`` within a file: joins and
    groupings by these columns then need no exchange of the target.
    """

    sort_by: tuple[str, ...] = ()
    ranged: bool = False
    ranges: int | None = None
    partition_by: tuple[str, ...] = ()
    spread_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int | None = None
    row_group_bytes: int | None = None
    compression: str | None = None

    def __post_init__(self):
        for name in ("sort_by", "partition_by", "spread_by", "bucket_by"):
            if isinstance(getattr(self, name), str):
                raise TypeError(f"{name} takes a tuple of column names")
        if self.ranged and not self.sort_by:
            raise ValueError("a ranged layout needs sort_by")
        if self.ranges is not None and not (self.ranged and self.ranges > 0):
            raise ValueError("ranges is the number of files of a ranged layout")
        if bool(self.bucket_by) != (self.buckets is not None) or (self.buckets is not None and self.buckets < 1):
            raise ValueError("bucket_by and a number of buckets go together")
        if sum(map(bool, (self.ranged, self.partition_by, self.spread_by, self.bucket_by))) > 1:
            raise ValueError("choose one of ranged, partition_by, spread_by and bucket_by")

    def write_options(self) -> dict[str, str]:
        options = {}
        if self.row_group_bytes:
            options["parquet.block.size"] = str(self.row_group_bytes)
        if self.compression:
            options["compression"] = self.compression
        return options


@dataclass(frozen=True)
class JdbcSource:
    """Connection to a remote database.

    ``partition_column`` splits the read into ``num_partitions`` key ranges. Give
    a unique key: equal-width ranges over it cannot hold a hot value. ``bounds``
    are its smallest and largest value, if they are known; else the remote
    database is asked for them, which runs the query once more. Without
    ``partition_column`` one task reads everything.

    For a sparse or skewed key give ``sample``, a condition by which the remote
    database keeps some of the rows (``RAND() < 0.001``): the ranges are then cut
    at equal shares of the sampled keys. ``cuts`` gives them at once, as SQL values in
    ascending order; one that stands there more than once is a hot value. A hot value
    has a range of its own, or several by ``split_hot``, a remote expression that is
    a whole number of 0 or more.
    """

    url: str
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    partition_column: str | None = None
    num_partitions: int = 1
    bounds: tuple | None = None
    sample: str | None = None
    cuts: tuple[str, ...] | None = None
    split_hot: str | None = None
    fetch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        if self.num_partitions > 1 and not self.partition_column:
            raise ValueError("num_partitions needs a partition_column")
        if self.bounds is not None and self.num_partitions < 2:
            raise ValueError("bounds need num_partitions")
        if self.sample is not None and self.num_partitions < 2:
            raise ValueError("sample needs num_partitions")
        if self.cuts is not None and not self.partition_column:
            raise ValueError("cuts need a partition_column")
        if sum(x is not None for x in (self.bounds, self.sample, self.cuts)) > 1:
            raise ValueError("choose one of bounds, sample and cuts")


RangeClause = str | Callable[[Column], Column]


@dataclass(frozen=True)
class TransferSpec:
    """One target table and the query that fills it.

    The rows come from ``query`` (SQL text, run by Spark, or by the remote
    database when ``jdbc`` is given) or from ``frame`` (a function that builds a
    DataFrame). A ``range_clause`` makes the transfer incremental. As text it is
    appended to the query with the mark put in place of ``{max_primary_key}``, or
    bound as the parameter ``:max_primary_key``; as a function it takes the mark
    as a literal column and returns a filter.

    ``row_key`` names columns that identify a row. It is needed for
    ``rescan_ties`` (rows equal to the mark that came late are looked for again)
    and to complete an append that a lost driver left open.

    ``trust_mark`` takes the mark of the listed files, without a look for others.
    It suits targets that nothing but these transfers writes.

    ``look_first`` looks for a first new row before an append is begun, so a rerun
    without new rows writes nothing. Turn it off for a query that is dear to begin,
    such as one with an aggregate: it would run once more.

    ``args`` are values for the named parameters of a SQL query.
    """

    alias: str
    query: str | None = None
    frame: Callable[[SparkSession], DataFrame] | None = None
    jdbc: JdbcSource | None = None
    primary_key: str | None = None
    range_clause: RangeClause | None = None
    database: str | None = None
    layout: Layout = Layout()
    interval: str | None = None
    row_key: tuple[str, ...] = ()
    rescan_ties: bool = False
    trust_mark: bool = False
    look_first: bool = True
    schema: StructType | None = None
    truncate_seconds: bool = False
    args: Mapping[str, object] | None = None

    def __post_init__(self):
        check_name("alias", self.alias)
        if self.database is not None:
            check_name("database", self.database)
        if (self.query is None) == (self.frame is None):
            raise ValueError(f"{self.alias}: give either a query or a frame")
        if self.jdbc is not None and self.query is None:
            raise ValueError(f"{self.alias}: a jdbc source needs a query")
        if self.range_clause is not None and not self.primary_key:
            raise ValueError(f"{self.alias}: a range clause needs a primary_key")
        if isinstance(self.range_clause, str):
            if self.frame is not None:
                raise ValueError(f"{self.alias}: a frame takes a function as range_clause")
            if self.jdbc is not None and f":{MARK_PARAMETER}" in self.range_clause:
                raise ValueError(f"{self.alias}: a jdbc range clause takes {MARK_TEXT}, no parameter")
        if self.args and (self.query is None or self.jdbc is not None):
            raise ValueError(f"{self.alias}: args need a SQL query")
        if isinstance(self.row_key, str):
            raise TypeError("row_key takes a tuple of column names")
        if self.rescan_ties and not (self.row_key and self.incremental):
            raise ValueError(f"{self.alias}: rescan_ties needs a row_key and a range clause")

    @property
    def incremental(self) -> bool:
        return self.range_clause is not None


@dataclass(frozen=True)
class Step:
    """A SQL statement that is run once, before or after the loads of an alias."""

    version: str
    query: str
    lifecycle: str = BEFORE

    def __post_init__(self):
        if not self.version:
            raise ValueError("a step needs a version")
        if self.lifecycle not in LIFECYCLES:
            raise ValueError(f"step {self.version}: lifecycle must be one of {LIFECYCLES}")


def trigger_interval(text: str) -> str:
    """The interval of a spec as Spark's trigger takes it; an ISO duration such as ``PT30S`` is converted."""
    found = _DURATION.fullmatch(text.strip())
    if found is None or not any(found.groups()):
        return text
    days, hours, minutes, seconds = (float(part or 0) for part in found.groups())
    total = ((days * 24 + hours) * 60 + minutes) * 60 + seconds
    return f"{round(total * 1000)} milliseconds"


def version_order(version: str) -> tuple:
    """Sort key that puts version 9 before version 10."""
    parts = re.split(r"(\d+)", version)
    return tuple((1, int(p), "") if p.isdigit() else (0, 0, p) for p in parts)


def ordered_steps(steps) -> list[Step]:
    ordered = sorted(steps, key=lambda s: version_order(s.version))
    for one, other in zip(ordered, ordered[1:]):
        if one.version == other.version:
            raise ValueError(f"duplicate step version {one.version}")
    return ordered
