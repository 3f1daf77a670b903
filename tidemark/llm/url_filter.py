"""Allow and block lists for URLs, as a cascade of Bloom filters.

The first filter holds the listed keys. The second holds those keys of the corpus that are
not listed but pass the first, the third those listed that pass the second, and so on,
until no key passes wrongly. As the levels are built over every key that the URLs of the
corpus give, membership is exact for them, and judging a URL needs no join.

A key is a host or one of its parents, with a beginning of the path as long as the path of
some rule. A URL without ``://``, or null, has an empty host and path and fits no rule. Rules
may repeat; of two rules that a URL fits the longer wins, then the one with the longer host.
An empty list of rules allows everything.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.store import stored
from tidemark.llm.words import mix

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hashed(host: Column, path: Column) -> list[Column]:
    """Two hashes of a host and a path as two values, so that ("example.co", "m/") is not ("example.com", "/")."""
    return [F.xxhash64(host, path).alias("h1"), F.xxhash64(F.reverse(path), F.lit(1), F.reverse(host)).alias("h2")]


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys of a URL, as an array of (rule, host length, two hashes)."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    parents = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    begun = F.array(*(F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths))
    begun = F.filter(begun, lambda p: p.isNotNull())

    def key(parent, beginning):
        return F.struct(F.concat(parent, beginning).alias("rule"), F.length(parent).alias("host_chars"), *_hashed(parent, beginning))

    made = F.flatten(F.transform(parents, lambda h: F.transform(begun, lambda p: key(h, p))))
    return F.when(host != "", made)


@dataclass
class Cascade:
    """Levels of (bits, number of hashes, words of the filter)."""

    levels: list[tuple[int, int, np.ndarray]]

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        bits, hashes, filled = self.levels[level]
        found = np.ones(len(h1), bool)
        for i in range(hashes):
            at = position(h1, h2, level, i, bits)
            found &= (filled[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        return found

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Membership; exact for listed keys and for the keys the cascade was built over."""
        result = np.zeros(len(h1), bool)
        open_ = np.arange(len(h1))
        for level in range(len(self.levels)):
            found = self.passes(level, h1[open_], h2[open_])
            result[open_[~found]] = level % 2 == 1
            open_ = open_[found]
        result[open_] = len(self.levels) % 2 == 1
        return result

    @property
    def size(self) -> int:
        return sum(x.nbytes for _, _, x in self.levels)


def position(h1: np.ndarray, h2: np.ndarray, level: int, i: int, bits: int) -> np.ndarray:
    n = np.uint64(level * 64 + i + 1)
    return (mix(h1.view(np.uint64) + n * h2.view(np.uint64), level) % np.uint64(bits)).astype(np.int64)


def _filled(keys: DataFrame, level: int, bits: int, hashes: int) -> np.ndarray:
    """The words of one filter: each task makes the words its keys touch, Spark ORs them."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
            at = np.concatenate([position(h1, h2, level, i, bits) for i in range(hashes)])
            at = np.unique(at)
            word, first = np.unique(at >> 6, return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], ["word", "value"])

    made = keys.select("h1", "h2").mapInArrow(words, "word long, value long").groupBy("word").agg(
        F.bit_or("value").alias("value"))
    filled = np.zeros((bits + 63) // 64, np.uint64)
    rows = made.toArrow()  # at most one row for each word, and the number of words is checked
    filled[rows["word"].to_numpy()] = rows["value"].to_numpy().view(np.uint64)
    return filled


def build(listed: DataFrame, universe: DataFrame, max_bytes: int = 64 << 20, max_levels: int = 64) -> Cascade:
    """A cascade for the keys ``listed`` (h1, h2), exact over the keys ``universe`` (h1, h2).

    The false positive rate of the first level follows from the two counts, so that about as
    many keys of the universe pass as are listed; later levels have a rate of a half. A
    cascade above ``max_bytes`` is refused before anything of it is collected.
    """
    spark = listed.sparkSession
    listed = stored(listed.select("h1", "h2").distinct())
    r, s = listed.count(), universe.count()
    levels: list[tuple[int, int, np.ndarray]] = []
    if not r:
        return Cascade(levels)
    rate = min(0.5, r * math.sqrt(0.5) / max(1, s))
    inside, outside, size = listed, None, 0
    while True:
        n = r if not levels else inside.count()
        if levels and not n:
            return Cascade(levels)
        bits = max(64, math.ceil(n * 1.4427 * math.log2(1 / rate)))
        size += bits // 8
        if size > max_bytes or len(levels) == max_levels:
            raise ValueError(f"the cascade needs over {size} bytes; list fewer keys or raise max_bytes")
        levels.append((bits, max(1, round(math.log2(1 / rate))), _filled(inside, len(levels), bits, max(1, round(math.log2(1 / rate))))))
        sent = spark.sparkContext.broadcast(levels)  # under max_bytes
        level = len(levels) - 1

        def wrong(batches, sent=sent, level=level):
            cascade = Cascade(sent.value)
            for batch in batches:
                found = cascade.passes(level, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2")))
                yield batch.filter(pa.array(found))

        passed = (universe if outside is None else outside).select("h1", "h2").mapInArrow(wrong, "h1 long, h2 long")
        if outside is None:  # only what passes is made distinct and compared with the list
            passed = passed.distinct().join(listed, ["h1", "h2"], "left_anti")
        inside, outside, rate = stored(passed), inside, 0.5


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", other: str = ALLOW, max_bytes: int = 64 << 20) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced.

    ``rules`` has host, path, verdict; a row with a null in one of them, or an empty host, is ignored.
    A URL that fits no rule gets ``other``. Of the lists only the filters travel to the tasks.
    Rules may have up to 1000 different path lengths.
    """
    spark = pages.sparkSession
    rules = rules.select(
        F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").dropna().where("host != ''")
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().limit(1001).collect())
    if len(lengths) > 1000:
        raise ValueError("rules have more than 1000 path lengths")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    if lengths:
        keys = keys_of(F.col("host"), F.col("path"), lengths)
    else:
        keys = F.lit(None).cast("array<struct<rule:string,host_chars:int,h1:bigint,h2:bigint>>")
    universe = pages.select(host.alias("host"), path.alias("path")).select(F.explode(keys).alias("k")).select("k.h1", "k.h2")
    # Of rules that repeat with different verdicts, a block counts.
    listed = rules.groupBy("host", "path").agg(F.max(F.col("verdict") == BLOCK).alias("blocked")).select(
        *_hashed(F.col("host"), F.col("path")), "blocked")
    member = build(listed, universe, max_bytes)
    block = build(listed.where("blocked"), listed, max_bytes)
    sent = spark.sparkContext.broadcast((member.levels, block.levels))

    kept = [f for f in pages.schema.fields if f.name not in ("host", "path", "rule", "verdict")]
    made = f"own_{uuid.uuid4().hex}"  # a name that no table has

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, block = (Cascade(x) for x in sent.value)
        for batch in batches:
            column = batch.column(made)
            flat, ends = column.flatten(), np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
            h1, h2 = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
            hit = np.flatnonzero(member.contains(h1, h2))
            blocked = block.contains(h1[hit], h2[hit])
            names = flat.field("rule").take(pa.array(hit)).to_pylist()
            hosts = flat.field("host_chars").take(pa.array(hit)).to_pylist()
            best: dict[int, int] = {}
            for k, row in enumerate((np.searchsorted(ends, hit, "right") - 1).tolist()):
                if row not in best or (len(names[k]), hosts[k]) > (len(names[best[row]]), hosts[best[row]]):
                    best[row] = k
            rule, verdict = [None] * len(batch), [other] * len(batch)
            for row, k in best.items():
                rule[row], verdict[row] = names[k], BLOCK if blocked[k] else ALLOW
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != made), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                [*(c for c in batch.schema.names if c != made), "rule", "verdict"])

    schema = ", ".join([
        *(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "host string, path string, rule string, verdict string"])
    return pages.select(*(F.col(f"`{f.name}`") for f in kept), host.alias("host"), path.alias("path")).withColumn(
        made, keys).mapInArrow(longest, schema)
