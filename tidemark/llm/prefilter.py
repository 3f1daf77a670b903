"""Rows whose id may be in a set, by a Bloom filter of bounded size, before an exact join.

A join that needs a few of many rows moves only about those; whatever passes wrongly is removed by the join.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.url_filter import Cascade, _filled

MAX_BITS = 1 << 26  # 8 MB; a hundredth of other ids pass with up to 6 million ids, more of them beyond


def own_name() -> str:
    """A name for a column that no table has."""
    return f"own_{uuid.uuid4().hex}"


def marked(rows: DataFrame, column: str, ids: DataFrame, name: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``rows`` with a boolean ``name``: false only if ``column`` is in no row of ``ids``, a frame of one column; null is false."""
    hashed = lambda c: [F.xxhash64(F.lit(23), c).alias("h1"), F.xxhash64(F.lit(29), c).alias("h2")]
    keys = ids.select(*hashed(F.col(ids.columns[0])))
    bits = int(min(max_bits, max(64, 10 * ids.count())))
    sent = rows.sparkSession.sparkContext.broadcast([(bits, 5, _filled(keys, 0, bits, 5))])

    @pandas_udf("boolean")
    def may(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(Cascade(sent.value).passes(0, h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

    return rows.withColumn(name, F.col(column).isNotNull() & may(*hashed(F.col(column))))


def only(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` is in ``ids``, a frame of one column; each as often as it was."""
    may, wanted = own_name(), own_name()
    some = marked(rows, column, ids, may).where(F.col(may)).drop(may)
    return some.join(ids.select(F.col(ids.columns[0]).alias(wanted)), F.col(column) == F.col(wanted), "left_semi")


def without(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` is null or not in ``ids``. Rows that cannot be in it are not moved."""
    may, unwanted = own_name(), own_name()
    split = marked(rows, column, ids, may)
    unsure = split.where(F.col(may)).drop(may)
    return split.where(~F.col(may)).drop(may).unionByName(
        unsure.join(ids.select(F.col(ids.columns[0]).alias(unwanted)), F.col(column) == F.col(unwanted), "left_anti"))
