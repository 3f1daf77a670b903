"""Comparing the members of groups of any size, in tasks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def tiled(
    rows: DataFrame, key: list[str], compare: Callable[[pd.DataFrame, np.ndarray, np.ndarray], pd.DataFrame],
    schema: str, rows_per_tile: int = 1024, weight: str | None = None, weight_per_tile: int = 4 << 20,
) -> DataFrame:
    """Call ``compare(rows, left, right)`` so that each two rows of a group meet.

    A group is dealt into tiles of about ``rows_per_tile`` rows by a hash of ``id``, or of that sum of the
    column ``weight`` if it asks for more tiles; a task holds two tiles. Rows of different tiles meet once; for the meeting of a tile with itself, left and right are
    both all of it.
    """
    names = rows.columns
    tiles = F.ceil(F.count(F.lit(1)) / rows_per_tile)
    if weight:
        tiles = F.greatest(tiles, F.ceil(F.sum(weight) / weight_per_tile))
    counts = rows.groupBy(*key).agg(tiles.cast("int").alias("_tiles"))
    dealt = rows.join(counts, key).withColumn("_tile", F.pmod(F.xxhash64(F.col("id"), F.lit(3)), F.col("_tiles")).cast("int"))
    met = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))).withColumn(
        "_lo", F.least("_tile", "_other")).withColumn("_hi", F.greatest("_tile", "_other"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf["_lo"].iloc[0], pdf["_hi"].iloc[0]
        tile = pdf["_tile"].to_numpy()
        return compare(pdf[names], np.flatnonzero(tile == lo), np.flatnonzero(tile == hi))

    return met.groupBy(*key, "_lo", "_hi").applyInPandas(run, schema)
