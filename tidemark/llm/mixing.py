"""Mixing sources to target weights, with a limit on how often a source is repeated.

Every source has a weight and a size; a share of the total is given to each by weight. A source
cannot take more than ``epochs`` times its size; what it cannot take is given to the others by
weight, until no source is above its limit. Then each document is repeated: whole repetitions
for all, and one more for a seeded choice of documents that makes up the fraction.

Documents without words (null or empty texts) have size 0 and are never taken. A null source is a source
of its own, after all others. Null ids and rows that repeat are mixed like others. Only doc_id, source and
text are read, so columns of other names do not matter. An empty table gives an empty mix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from tidemark.llm.prefilter import own_name
from tidemark.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def checksum(text: Column) -> Column:
    """Tells texts of one id apart; -1 for null."""
    return F.coalesce(F.crc32(text), F.lit(-1)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with their rank by code point, null last, from 0; no task sees all of them."""
    # UTF-8 sorts by code point. Each range is counted, and ranks begin after the ranges before it.
    dealt = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    dealt = stored(dealt)
    own = F.row_number().over(W.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())) - 1
    before, offset = {}, 0
    for part, n in sorted(dealt.groupBy("_part").count().collect()):  # a row for each partition
        before[part] = offset
        offset += n
    start = F.coalesce(*(F.when(F.col("_part") == p, F.lit(n)) for p, n in before.items()), F.lit(0)) if before else F.lit(0)
    return dealt.withColumn("rank", (own + start).cast("long")).drop("_part")


def water_fill(sources: DataFrame, epochs: int = 3) -> DataFrame:
    """source, size, weight -> also ``target`` and ``capped``.

    Each round gives what is left to the sources not yet at their limit, by weight, and sets
    those that would pass it to the limit. Rounds end when none does. A round is one sum over
    the sources; only its three numbers come to the driver.
    """
    sources = sources.withColumn("cap", F.col("size") * epochs)
    level = None  # what a weight of 1 gets
    total = sources.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    full, light, rounds = 0, 0.0, 0
    while True:
        # A source is at its limit if its share at the last level passes it; levels only rise.
        over = F.lit(False) if level is None else F.col("cap") < F.col("weight") * level
        full_now, light_now, n = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1))).first()
        if not light_now:  # all are at their limit
            return sources.withColumn("target", F.col("cap").cast("double")).withColumn("capped", F.lit(True))
        if level is not None and n == rounds:
            break
        full, light, rounds = full_now, light_now, n
        level = (total - full) / light
    capped = F.col("cap") < F.col("weight") * level
    share = F.col("weight") * F.lit(float(total - full)) / F.lit(float(light))
    return sources.withColumn("target", F.when(capped, F.col("cap").cast("double")).otherwise(share)).withColumn("capped", capped)


def choose(sizes: np.ndarray, fraction: float, key: np.ndarray) -> np.ndarray:
    """Documents whose sizes add up to ``fraction`` of all, spread over sizes.

    Largest first, ties by ``key``: a document is taken when what is owed so far is at least half of it.
    The sum ends about half a small document from what is asked.
    """
    taken = np.zeros(len(sizes), bool)
    owed = 0.0
    if fraction <= 1e-12:
        return taken
    for i in np.lexsort((key, -sizes)):
        owed += fraction * sizes[i]
        if sizes[i] and owed >= sizes[i] / 2:
            taken[i] = True
            owed -= sizes[i]
    return taken


def mix(
    documents: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: int = 3, seed: int = 17, rows: int = 4096
) -> DataFrame:
    """doc_id, source, checksum, size, source_size, target, taken and repeats, for every document.

    The fraction of a source is chosen in groups of about ``rows`` documents by a hash, so a source of any
    size is spread over tasks; each group meets the fraction by itself. Rows alike in id, source and text
    are chosen together.
    """
    sizes = documents.select("doc_id", "source", checksum(F.col("text")).alias("checksum"), word_count(F.col("text")).alias("size"))
    sizes = stored(sizes.groupBy("doc_id", "source", "checksum", "size").agg(F.count(F.lit(1)).alias("copies")))
    sources = ranked(sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("size"), F.count(F.lit(1)).alias("rows")))
    turn = F.array(*(F.lit(float(w)) for w in weights))
    sources = sources.withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")))
    filled = stored(water_fill(sources, epochs)).select(
        F.col("source").alias("_source"), F.col("size").alias("source_size"), "target",
        F.ceil(F.col("rows") / rows).cast("long").alias("_groups"))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("checksum"))
    joined = sizes.join(filled, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "checksum", "size", "copies", "source_size", "target", key.alias("_key"),
        F.pmod(F.xxhash64(F.lit(seed + 1), key), F.col("_groups")).alias("_group"))

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        times = target / total if total else 0.0
        whole = min(int(times), epochs)
        size = pdf["size"].to_numpy()
        more = choose(size * pdf["copies"].to_numpy(), times - whole, pdf["_key"].to_numpy())
        repeats = np.where(size > 0, whole + more, 0).astype(np.int64)
        return pdf[["doc_id", "source", "checksum", "size", "copies", "source_size", "target"]].assign(
            taken=repeats * size, repeats=repeats)

    kind = documents.schema["doc_id"].dataType.simpleString()
    chosen = joined.groupBy("source", "_group").applyInPandas(
        group, f"doc_id {kind}, source string, checksum long, size long, copies long, source_size long, "
               "target double, taken long, repeats long")
    return chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("_copy", "copies")


def repeated(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it, with all their columns, whatever these are called."""
    doc, source, kind, times, turn = (own_name() for _ in range(5))
    own = mixed.where("repeats > 0").select(
        F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("checksum").alias(kind), F.col("repeats").alias(times)).distinct()
    same = (
        F.col("doc_id").eqNullSafe(F.col(doc)) & F.col("source").eqNullSafe(F.col(source)) & (checksum(F.col("text")) == F.col(kind)))
    return documents.join(own, same).select(
        *(F.col(f"`{c}`") for c in documents.columns), F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))).alias(turn)).drop(turn)
