"""Byte-level BPE with the vocabulary of a public tokenizer file, and back.

A text is cut at the special tokens of the file, then by the pattern of the byte-level family, and each piece is
merged by itself: its symbols form a doubly linked list, and a heap holds the possible merges by rank, then by place.
A merge that was overtaken by another one is recognised when it is taken from the heap, and skipped. Null is
encoded as empty, and empty gives no ids. Decoding joins the bytes of the vocabulary entries; bytes that are no UTF-8
become U+FFFD. Rows keep their order and number; repeated rows and null ids stay as they are.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.words import blocks

# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# The same for texts without numbers that are no decimal digits and without 0x1C to 0x1F.
PLAIN = r"""'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]+|_+)+|\s+(?!\S)|\s+"""
_CONTROL = re.compile(r"[\x1c-\x1f]").search


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in such vocabularies: itself, or the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Bpe:
    """Merges and vocabulary; made on the driver from a file, sent to tasks as a broadcast."""

    def __init__(self, path: str, cached: int = 100_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        shown = byte_characters()
        back = {c: b for b, c in shown.items()}
        self.first = [vocab[shown[b]] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.entries = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in vocab.items():
            self.entries[i] = bytes(back[c] for c in text) if all(c in back for c in text) else text.encode()
        for text, i in self.special.items():
            self.entries[i] = text.encode()
        self.cached = cached
        self.cache: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self._find = self._cut = None

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "old": {}, "_find": None, "_cut": None}

    def piece(self, text: str) -> tuple[int, ...]:
        """The ids of a piece, by merging."""
        ids = [self.first[b] for b in text.encode("utf-8")]
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges, heap = self.merges, []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((made, ids[k])):
                    heapq.heappush(heap, (found[0], i, made, ids[k], found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], made))):
                heapq.heappush(heap, (found[0], h, ids[h], made, found[1]))
        return tuple(x for x in ids if x >= 0)

    def _pieces(self, text: str) -> list[str]:
        """Cut by the pattern. Without the characters on which they differ, the standard module gives the same, sooner."""
        if self._find is None:
            import regex

            self._find = regex.compile(PATTERN).findall, regex.compile(r"[\p{Nl}\p{No}\x1c-\x1f]").search, re.compile(PLAIN).findall
        exact, unlike, plain = self._find
        return (plain if text.isascii() and not _CONTROL(text) or not unlike(text) else exact)(text)

    def encode(self, text: str) -> list[int]:
        if self._cut is None:
            names = "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))
            self._cut = re.compile(f"({names})").split if names else lambda t: [t]
        ids: list[int] = []
        cache = self.cache
        parts = self._cut(text) if any(t in text for t in self.special) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(self.special[part])
                continue
            pieces = self._pieces(part)
            found = list(map(cache.get, pieces))
            if None in found:
                if len(cache) >= self.cached:  # what is still in use moves from the old to the new
                    self.old, self.cache = cache, {}
                    cache = self.cache
                for i, ready in enumerate(found):
                    if ready is None:
                        piece = pieces[i]
                        found[i] = cache.get(piece) or self.old.get(piece) or self.piece(piece)
                        if len(piece) <= 64:
                            cache[piece] = found[i]
            ids += chain.from_iterable(found)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.entries.__getitem__, ids)).decode("utf-8", "replace")


def encoded(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``documents`` without the text, with ``ids``, an array of integers; a column ``ids`` is replaced."""
    spark: SparkSession = documents.sparkSession
    sent = spark.sparkContext.broadcast(Bpe(path))  # the size of the vocabulary file
    kept = [f for f in documents.schema.fields if f.name not in (text, "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for at, part in blocks(batch.column(text), 1 << 20):
                flat, ends = [], [0]
                for t in part:
                    flat += model.encode(t.decode("utf-8", "replace"))
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat, np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f.name).slice(at, len(part)) for f in kept), ids], [*(f.name for f in kept), "ids"])
        model.cache, model.old = {}, {}  # a worker lives longer than its task

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "ids array<int>"])
    return documents.select(*(f"`{f.name}`" for f in kept), documents[text].cast("string").alias(text)).mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Rows with ``ids`` -> also ``decoded``, the text, and ``ids_sha256`` over the ids joined by commas."""
    sent = rows.sparkSession.sparkContext.broadcast(Bpe(path))
    kept = [f for f in rows.schema.fields if f.name not in ("decoded", "ids_sha256")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = [str(i) for i in range(len(model.entries))]
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, len(b), 1000)):
            column = batch.column("ids")
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
            flat = column.flatten().to_numpy()
            texts, digests = [], []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                ids = flat[a:b].tolist()
                texts.append(model.decode(ids))
                digests.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                [*(f.name for f in kept), "decoded", "ids_sha256"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "decoded string", "ids_sha256 string"])
    return rows.select(*(f"`{f.name}`" for f in kept)).mapInArrow(run, schema)
