"""Near duplicates by word shingles, found with HyperMinHash sketches.

A text is lower-cased (A-Z) and cut into words; its set holds the distinct runs of ``width`` words, or
all words as one run if they are fewer. Two documents are linked when 100 * intersection is at least
``percent`` times the union. Texts without words have an empty set and link with nothing; null ids too.

1. Documents of equal sets form a class; its smallest id stands for it from here on.
2. A sketch has 256 buckets. Each shingle falls into one by the top bits of its hash, and the
   smallest hash in a bucket is kept as the number of its leading zeros and the 10 bits that follow the
   first one. Empty buckets borrow from a filled one by an order that is the same for all documents.
3. Registers are banded. In each bucket of a band, members are compared with its smallest id, then, where
   members of several components remain, with its largest, then in tiles of all that remain. A tile
   compares sets in the task and gives only links between components; no step emits the pairs of a group.
4. Pairs with a smallest or largest id are judged by the sketches first: Jaccard from equal registers, corrected for registers that
   are equal by chance. Only what is more than six deviations below the threshold is left out.
5. What is left is confirmed on the full sets of both texts.

The number of registers in a band is the largest that misses a pair at the threshold with a
probability of 1e-8 or less. Sets are compared by 64-bit hashes: words by BLAKE2, shingles by a chain over their words, and classes are
formed by 128 bits of BLAKE2 over the whole set. Rows that repeat an id belong to one node, also with different texts: the
classes of all its texts are linked. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components, joined
from tidemark.llm.prefilter import only, without
from tidemark.llm.store import freed, stored
from tidemark.llm.tiles import tiled
from tidemark.llm.words import Block, Words, blocks, chained, chains, mix

BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
MANTISSA = 10
_PROBES = np.argsort(np.random.default_rng(5).random((BUCKETS, BUCKETS)), axis=1).astype(np.int64)
_RANKS = np.argsort(_PROBES, axis=1)  # [bucket, source] -> when the source is asked


def band_size(percent: int, miss: float = 1e-8) -> int:
    """The most registers in a band with which a pair at the threshold is missed that rarely."""
    j = percent / 100
    return max(r for r in range(1, 33) if r == 1 or (1 - j**r) ** (BUCKETS // r) <= miss)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, in order."""
    block = Block.of(texts)
    words = Words.of(block)
    hashes = words.strong_hashes(block, lower=True)
    grams, at = chains(words, hashes, width)
    first = np.searchsorted(at, words.first)
    for i, n in enumerate(words.counts()):
        if n >= width:
            yield np.unique(grams[first[i]:first[i + 1]])
        elif n:
            yield chained(words, hashes, i)
        else:
            yield np.zeros(0, np.uint64)


def registers(smallest: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of hashes whose top bits named the bucket."""
    x = (smallest << np.uint64(BUCKET_BITS)) >> np.uint64(11)  # 53 bits, exact as a float
    length = np.frexp(x.astype(np.float64))[1].astype(np.uint64)
    zeros = np.uint64(53) - length
    body = (x << (zeros + np.uint64(1))) & np.uint64((1 << 53) - 1)
    return (zeros << np.uint64(MANTISSA) | body >> np.uint64(53 - MANTISSA)).astype(np.uint16)


def sketch(unique: np.ndarray) -> np.ndarray:
    """The registers of a set that is not empty; empty buckets borrow."""
    bucket = (unique >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    filled = bucket[first]
    own = registers(unique[first])
    if len(filled) == BUCKETS:
        return own
    out = np.zeros(BUCKETS, np.uint16)
    empty = np.ones(BUCKETS, bool)
    empty[filled] = False
    out[filled] = own
    out[empty] = own[_RANKS[np.ix_(empty, filled)].argmin(axis=1)]
    return out


def chance(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The probability that registers of disjoint sets of these sizes are equal."""
    total = np.zeros(len(na))
    edges = 0.5 ** np.arange(0, 41)
    a, b = (np.maximum(n, BUCKETS) / BUCKETS for n in (na, nb))  # a borrowed register has one element at least
    for high, low in zip(edges[:-1], edges[1:], strict=True):
        total += (np.exp(-a * low) - np.exp(-a * high)) * (np.exp(-b * low) - np.exp(-b * high))
    return total / (1 << MANTISSA)


def estimate(equal: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    c = chance(na, nb)
    return (equal / BUCKETS - c) / (1 - c)


def plausible(equal: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether the estimate leaves a pair any chance of reaching the threshold."""
    t = percent / 100
    kept = np.minimum(BUCKETS, np.maximum(1, np.minimum(na, nb) / 2))
    fits = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
    return fits & (estimate(equal, na, nb) >= t - 6 * np.sqrt(t * (1 - t) / kept))


def sketches(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, digest (two longs) and registers of every document."""
    # A smaller set reaches the threshold with an equal one only.
    least = next(n for n in range(1, 101) if 100 * n >= percent * (n + 1)) if percent < 100 else 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for at, texts in blocks(batch.column("text")):
                counts, digests, held = [], [], []
                for unique in shingle_sets(texts, width):
                    n = len(unique)
                    counts.append(n)
                    digests.append(np.frombuffer(blake2b(unique.tobytes(), digest_size=16).digest(), np.uint64))
                    held.append(sketch(unique).tobytes() if n >= least else None)
                d = np.array(digests, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, len(texts)), pa.array(counts, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]),
                    pa.array(held, pa.binary())], ["doc_id", "n_shingles", "d1", "d2", "registers"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, d1 long, d2 long, registers binary")


def banded(known: DataFrame, percent: int) -> DataFrame:
    """id with a hash of each band of the registers, a row each."""
    size = band_size(percent)
    bands = BUCKETS // size
    scale = np.random.default_rng(6).integers(1, 1 << 63, (bands, size), dtype=np.uint64) | np.uint64(1)
    kind = known.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, len(b), 1024)):
            rows = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, BUCKETS)
            cut = rows[:, : bands * size].reshape(-1, bands, size).astype(np.uint64)
            made = mix((cut * scale).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)
            own = pa.array(np.repeat(np.arange(len(batch)), bands))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(own), pa.array(made.reshape(-1))], ["id", "band"])

    return known.select("id", "registers").mapInArrow(run, f"id {kind}, band long")


def _judged(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches leave them a chance."""
    sizes = [known.select(F.col("id").alias(side), F.col("n").alias(f"n{side}")) for side in "ab"]
    left, right = (known.select(F.col("id").alias(side), F.col("registers").alias(f"r{side}")) for side in "ab")

    def run(batches):
        for batch in batches:
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            yield batch.select(["a", "b"]).filter(pa.array(plausible((ra == rb).sum(axis=1), na, nb, percent)))

    kind = known.schema["id"].dataType.simpleString()
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    some = pairs.join(sizes[0], "a").join(sizes[1], "b").where(fits)  # before any sketch is moved
    return some.join(left, "a").join(right, "b").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def confirmed(pairs: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) that are linked by the full sets of their texts, written."""
    texts = documents.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    need = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    # Else the join moves all texts. Written, so that no task runs two Python functions at once.
    texts = stored(only(texts, "id", need))
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for at, texts_a in blocks(batch.column("ta")):
                mine = shingle_sets(texts_a, width)
                other = (s for _, t in blocks(batch.column("tb").slice(at, len(texts_a))) for s in shingle_sets(t, width))
                for i, (x, y) in enumerate(zip(mine, other, strict=True)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[at + i] = 100 * common >= percent * (len(x) + len(y) - common) and len(x) > 0
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    kind = pairs.schema["a"].dataType.simpleString()
    found = stored(both.mapInArrow(run, f"a {kind}, b {kind}").distinct())
    freed(texts)
    return found


def _open_groups(bands: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (band, id, component) of the buckets that hold several components."""
    named = bands.select("band", "id").join(labels.select("id", "component"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    mixed = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("band")
    return stored(named.join(mixed, "band", "left_semi"))


def full_sets(documents: DataFrame, ids: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """The texts of the documents in ``ids``, written, and of these id, n and the set of 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in blocks(batch.column("text")):
                sets = [u.view(np.int64) for u in shingle_sets(texts, width)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(at, len(texts)), pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))], ["id", "n", "shingles"])

    kind = ids.schema["id"].dataType.simpleString()
    texts = documents.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    texts = stored(only(texts, "id", ids))
    return texts, texts.mapInArrow(run, f"id {kind}, n long, shingles array<long>")


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of left x right, as products of membership matrices, some columns at a time; exact."""
    sizes = [len(s) for s in sets]
    names, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = count > 1  # a shingle of one set is in no intersection
    number = np.cumsum(shared) - 1
    row, column = row[shared[column]], number[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)))  # a part is below 2**24, the sum below 2**53
    for at in range(0, int(shared.sum()), columns):
        lo, hi = np.searchsorted(column, [at, at + columns])
        part = np.zeros((len(sets), columns), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        out += part[left] @ part[right].T
    return out


def joining(
    ids: np.ndarray, n: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int
) -> list[tuple]:
    """Linked pairs of left x right, as many as it takes to join their components."""
    made = []
    names, root = np.unique(comp, return_inverse=True)
    if len(names) > 1:
        common = common_counts(sets, left, right)
        union = n[left][:, None] + n[right][None, :] - common
        i, j = np.nonzero((100 * common >= percent * union) & (comp[left][:, None] != comp[right][None, :]))
        for x, y in zip(left[i].tolist(), right[j].tolist(), strict=True):
            if root[x] != root[y]:
                root[root == root[y]] = root[x]
                made.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return made


def _residual(members: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs that join the different components left in one bucket, found tile by tile, written.

    Each tile compares whole sets by the hashes that also confirm pairs, so that what it finds is linked, and gives
    no more pairs than it takes to join its rows.
    """
    # Buckets of the same members need one look.
    sums = (F.sum(F.xxhash64(F.lit(salt), F.col("id")).cast("decimal(38,0)")).alias(f"h{salt}") for salt in (1, 2))
    same = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), *sums, F.min("id").alias("m"))
    one = same.groupBy("n", "h1", "h2", "m").agg(F.min("band").alias("band"))
    texts, sets = full_sets(documents, members.select("id").distinct(), width)
    rows = members.join(one.select("band"), "band", "left_semi").join(sets, "id")
    kind = members.schema["id"].dataType.simpleString()

    def compare(pdf: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
        made = joining(
            pdf["id"].to_numpy(), pdf["n"].to_numpy(), pdf["component"].to_numpy(), pdf["shingles"].tolist(), left, right, percent)
        return pd.DataFrame(made, columns=["a", "b"], dtype=pdf["id"].dtype)

    found = stored(tiled(rows, ["band"], compare, f"a {kind}, b {kind}", 512, "n", 2 << 20).distinct())
    freed(texts)
    return found


def linked(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; see the module."""
    made = stored(sketches(documents, width, percent))
    key = ["n_shingles", "d1", "d2"]
    groups = made.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    members = made.select("doc_id", *key).join(groups, key, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"))
    members = stored(members)
    reps = members.where("doc_id = rep AND n_shingles > 0").select("doc_id").distinct()
    known = stored(made.where("registers IS NOT NULL").join(reps, "doc_id", "left_semi").select(
        F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "registers"))
    freed(made)  # what is needed of it has been written
    bands = banded(known, percent)
    shared = bands.groupBy("band").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi")
    bands = stored(bands.join(shared.select("band", "lo"), "band"))  # buckets of one member are gone
    pairs = bands.where("id <> lo").select(F.col("lo").alias("a"), F.col("id").alias("b")).distinct()
    links = confirmed(stored(_judged(pairs, known, percent)), documents, width, percent)
    named = members.where("doc_id IS NOT NULL")
    several = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("_hi")).where("a <> _hi").select("doc_id", "a")
    same_id = named.join(several, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    links = stored(links.unionByName(same_id))
    labels = components(links)

    open_ = _open_groups(bands, labels)
    freed(bands)
    if not open_.isEmpty():
        center = open_.groupBy("band").agg(F.max(F.struct("component", "id")).alias("c"))
        pairs = open_.join(center, "band").where("component <> c.component").select(
            F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct()
        more = confirmed(stored(_judged(pairs, known, percent)), documents, width, percent)
        freed(known)
        if not more.isEmpty():
            labels = joined(labels, more)
            open_ = _open_groups(open_, labels)
        rest = confirmed(_residual(open_, documents, width, percent), documents, width, percent)
        if not rest.isEmpty():
            labels = joined(labels, rest)
    return members.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and ``kept``: the row is the smallest id of its component.

    Copies count as linked; a row without an id is kept and has no component.
    """
    return linked(documents, width, percent).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each component left: all rows of its smallest id, once each."""
    found = near_duplicates(documents, width, percent)
    return without(documents, "doc_id", stored(found.where("NOT kept").select("doc_id").distinct()))
