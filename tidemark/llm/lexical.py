"""Ranked lexical search of many items at once, with what the items share evaluated once.

A document's score for an item is the sum, over the item's distinct terms, of impacts that depend on the term and the document
only. So the sum over a set of terms that several items share is computed once a document:

1. Terms that are in the same items form a class; its partial accumulator is the sum of its terms.
2. Shared sets of classes are mined from the items: each item is the sequence of its classes, the most shared first, and two neighbours
   that are neighbours in two items or more become a node, again and again. Nodes and classes are the query-sharing DAG.
3. Documents are cut into terms once. Numbers of documents, terms and of documents that hold a query term are counted over all rows; kept
   are, by document, its length and how often it holds each query term, written as Parquet.
4. For some documents at a time, accumulators of all classes are made, nodes are added up level by level, and items are
   sums of what is left in their sequences. All are 64-bit integers, so the order of sums does not matter.

Each task keeps the best of each item; those of all tasks are ranked by item and salt first, then by item. Items come in blocks of about ``max_terms``
terms, which bounds what is broadcast; each block is a pass of its own, so items of any number are ranked.

Terms are runs of ASCII letters and digits and of what is not ASCII, with A-Z as a-z. Null and empty texts have none; an item
without terms gives no rows, and so do empty tables. Rows that repeat an item's id are one item of all their terms; null is an id. Each row of the
documents is one of its own, also with a repeated or null id; a null id comes last among equal scores. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm.store import stored
from tidemark.llm.words import LOWER, Block, blocks

TERM = np.zeros(256, bool)
TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = LOWER.astype(np.uint8)
CELLS = 1 << 21  # accumulators of a block of documents
SALTS = 64


def terms(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts, in order, and the text each is in."""
    block = Block.of(texts)
    data = _LOWER[block.data]
    inside = TERM[data]
    edges = (np.flatnonzero(inside[1:] != inside[:-1]) + 1).astype(np.int32)
    if len(inside) and inside[0]:
        edges = np.concatenate([np.zeros(1, np.int32), edges])  # a block ends with a line feed, so each term has an end
    if not len(edges):
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    slices = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
    text = np.searchsorted(block.first, edges[::2], "right") - 1
    return slices.take(pa.array(np.arange(0, len(slices), 2))), text


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and term, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in blocks(batch.column("text")):
                found, text = terms(texts)
                yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(text + at)), found], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"item_id {kind}, term binary").distinct()


@dataclass(frozen=True)
class Plan:
    """The query-sharing DAG of a block of items: leaves are classes of terms, then nodes in an order that can be added up."""

    leaf: np.ndarray  # the class of each term
    leaves: int
    left: np.ndarray  # the two parts of each node
    right: np.ndarray
    levels: list[tuple[int, int]]  # ranges of nodes whose parts come before
    flat: np.ndarray  # what the items add up, one item after the other
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return self.leaves + len(self.left)

    def expanded(self, symbol: int) -> set[int]:
        """The terms of a class or node."""
        if symbol < self.leaves:
            return set(np.flatnonzero(self.leaf == symbol).tolist())
        k = symbol - self.leaves
        return self.expanded(int(self.left[k])) | self.expanded(int(self.right[k]))

    def totals(self, accumulators: np.ndarray) -> np.ndarray:
        """Rows of all classes, then room for nodes -> a row for each item."""
        for lo, hi in self.levels:
            accumulators[lo:hi] = accumulators[self.left[lo - self.leaves:hi - self.leaves]]
            accumulators[lo:hi] += accumulators[self.right[lo - self.leaves:hi - self.leaves]]
        return np.add.reduceat(accumulators[self.flat], self.offsets[:-1], axis=0)


def shared_plan(items: list[list[int]], n_terms: int) -> Plan:
    """Mine what items share; ``items`` hold the terms of each, numbered below ``n_terms``, at least one."""
    holders: list[list[int]] = [[] for _ in range(n_terms)]
    for i, own in enumerate(items):
        for t in own:
            holders[t].append(i)
    classes = {h: k for k, h in enumerate(sorted(set(map(tuple, holders)), key=lambda h: (-len(h), h)))}
    leaf = np.array([classes[tuple(h)] for h in holders], np.int64)
    sequences: list[list[int]] = [[] for _ in items]
    for held, k in classes.items():  # the most shared first
        for i in held:
            sequences[i].append(k)
    parts: list[tuple[int, int]] = []
    while True:
        counts = Counter(pair for s in sequences for pair in zip(s, s[1:]))
        # A pair is taken where neither neighbour pair is more frequent; it must be so in two items.
        taken: Counter = Counter()
        for s in sequences:
            taken.update(_chosen(s, counts).values())
        number = {pair: len(classes) + len(parts) + k for k, pair in enumerate(sorted(p for p, n in taken.items() if n > 1))}
        if not number:
            break
        parts += number
        for i, s in enumerate(sequences):
            at, out, chosen = 0, [], _chosen(s, counts)
            while at < len(s):
                pair = chosen.get(at)
                made = number.get(pair)
                out.append(s[at] if made is None else made)
                at += 1 if made is None else 2
            sequences[i] = out
    return _levelled(leaf, len(classes), parts, sequences)


def _chosen(s: list[int], counts: Counter) -> dict[int, tuple[int, int]]:
    """Places of pairs that do not overlap, the most frequent first, of two items at least."""
    pairs = sorted((-counts[s[i], s[i + 1]], s[i], s[i + 1], i) for i in range(len(s) - 1) if counts[s[i], s[i + 1]] > 1)
    chosen: dict[int, tuple[int, int]] = {}
    for _, a, b, i in pairs:
        if i not in chosen and i - 1 not in chosen and i + 1 not in chosen:
            chosen[i] = (a, b)
    return chosen


def _levelled(leaf: np.ndarray, leaves: int, parts: list[tuple[int, int]], sequences: list[list[int]]) -> Plan:
    depth = [0] * leaves
    for a, b in parts:
        depth.append(1 + max(depth[a], depth[b]))
    order = sorted(range(leaves, len(depth)), key=lambda k: depth[k])
    new = {k: k for k in range(leaves)} | {k: leaves + at for at, k in enumerate(order)}
    left, right = (np.array([new[parts[k - leaves][side]] for k in order], np.int64) for side in (0, 1))
    steps = [depth[k] for k in order]
    edges = [leaves + at for at in range(len(order)) if not at or steps[at] != steps[at - 1]] + [leaves + len(order)]
    flat = np.array([new[k] for s in sequences for k in s], np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
    return Plan(leaf, leaves, left, right, list(zip(edges[:-1], edges[1:])), flat, offsets)


def postings(documents: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, its number of terms ``n``, and by query term it holds the term's number and how often."""
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.binary())
        for batch in batches:
            for at, texts in blocks(batch.column("text"), 1 << 20):
                found, text = terms(texts)
                term = pc.fill_null(pc.index_in(found, value_set=known), -1).to_numpy(zero_copy_only=False)
                hit = term >= 0
                key, times = np.unique(text[hit] * len(known) + term[hit], return_counts=True)
                ends = pa.array(np.searchsorted(key, np.arange(len(texts) + 1) * len(known)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(texts)), pa.array(np.bincount(text, minlength=len(texts)), pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(key % len(known), pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))], ["doc_id", "n", "terms", "times"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, times array<int>")


def impacts(n: np.ndarray, doc: np.ndarray, times: np.ndarray, weight: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What each term of a document adds to the items that have it."""
    if len(n) and int(n.max()) * 90 * documents < 1 << 62:
        scaled = 90 * n * documents // total
    else:
        scaled = np.array([90 * int(x) * documents // total for x in n], np.int64)
    m = 100 - 90 + scaled
    times = times.astype(np.int64)
    return weight * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))


class _Best:
    """The highest scores of each item so far, equal ones by ascending id, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)  # the least score that may still get in
        self.rows: tuple[np.ndarray, ...] = (np.zeros(0, np.int64),) * 4

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.floor[:, None])
        new = (item, -scores[item, doc], null[doc].astype(np.int64), ids[doc])
        item, minus, null, ids = (np.concatenate(pair) for pair in zip(self.rows, new, strict=True))
        order = np.lexsort((ids, null, minus, item))
        item, minus, null, ids = item[order], minus[order], null[order], ids[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.k - 1
        self.floor[item[full]] = -minus[full]
        keep = place < self.k
        self.rows = tuple(x[keep] for x in (item, minus, null, ids))


def _best_of_tasks(held: DataFrame, plan: Plan, weights: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """The best of each item among the documents of each task: item (its place), doc_id, score."""
    spark = held.sparkSession
    sent = spark.sparkContext.broadcast((plan, weights))
    kind = held.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = sent.value
        best = _Best(len(plan.offsets) - 1, k)
        rows = max(1, CELLS // (plan.size + len(plan.flat)))
        for whole in batches:
            for batch in (whole.slice(at, rows) for at in range(0, len(whole), rows)):
                lists = batch.column("terms")
                doc = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
                term, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
                made = impacts(batch.column("n").to_numpy(), doc, times, weights[term], documents, total)
                accumulators = np.zeros((plan.size, len(batch)), np.int64)
                np.add.at(accumulators.reshape(-1), plan.leaf[term] * len(batch) + doc, made)
                ids = batch.column("doc_id")
                best.add(plan.totals(accumulators), pc.fill_null(ids, 0).to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False))
        item, minus, null, ids = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=null > 0), pa.array(-minus)], ["item", "doc_id", "score"])

    found = held.mapInArrow(run, "item int, doc_id long, score long")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item, first among those of equal salt, so that no task has all of an item's rows."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))
    some = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(W.partitionBy("item", "salt").orderBy(*order)))
    some = some.where(F.col("rank") <= k).select("item", "doc_id", "score")
    return some.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _search_block(spark: SparkSession, documents: DataFrame, rows: list, k: int, kind: str) -> DataFrame | None:
    """The ranking for the items whose (item_id, term) are given."""
    vocabulary = sorted({bytes(r["term"]) for r in rows})
    number = {t: i for i, t in enumerate(vocabulary)}
    own: dict[object, list[int]] = {}
    for r in rows:
        own.setdefault(r["item_id"], []).append(number[bytes(r["term"])])
    names = sorted(own, key=lambda i: (i is None, i))
    held = stored(postings(documents, vocabulary))
    n_documents, total = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not total:
        return None
    frequency = np.zeros(len(vocabulary), np.int64)
    for term, n in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row a query term
        frequency[term] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)
    plan = shared_plan([own[i] for i in names], len(vocabulary))
    found = _ranked(_best_of_tasks(held, plan, weights, n_documents, total, k), k)
    items = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {kind}")
    return found.join(F.broadcast(items), "item").select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, k: int = 10, max_terms: int = 1 << 18) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item, of those that score at all."""
    spark = documents.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    wanted = stored(item_terms(items))
    passes = math.ceil(wanted.count() / max_terms)
    found = None
    for p in range(passes):
        rows = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).collect()  # about ``max_terms``
        own = _search_block(spark, documents, rows, k, kind) if rows else None
        if own is not None:
            found = own if found is None else found.unionByName(own)
    if found is None:
        doc = documents.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {doc}, score long")
    return found
