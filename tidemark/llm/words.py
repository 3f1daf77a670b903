"""Words, n-grams and lines of many texts at once, as numpy arrays of 64-bit hashes.

Texts are joined with a line feed and handled as one array of bytes. A word is a run of
bytes other than space and 0x09 to 0x0D; these never occur inside a character of UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_SEED = np.random.default_rng(20240611)
# A random value for each byte; the hash of a word is a polynomial of these.
_VALUES = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_VALUES[SPACE] = 0
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_MULTIPLIERS = _SEED.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

LOWER = np.arange(256)
LOWER[65:91] += 32
_LOWER_VALUES = _VALUES[LOWER]
# Letters and what is not ASCII count, other bytes do not: "Word," hashes as "word".
CORE = np.zeros(256, bool)
CORE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CORE_VALUES = np.where(CORE, _LOWER_VALUES, 0).astype(np.uint64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finaliser of splitmix64: every bit of the input reaches every bit of the result."""
    x = x + np.uint64((salt * 2 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _UNBASE):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            made.append(np.multiply.accumulate(row))
        _powers = tuple(made)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Block:
    """Some texts; ``first`` holds where each begins in ``data``, and the end of the last."""

    data: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Block:
        joined = b"\n".join(texts) + b"\n"
        first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=first[1:])
        return cls(np.frombuffer(joined, np.uint8), first)

    def __len__(self) -> int:
        return len(self.first) - 1

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value for each byte, by text."""
        return np.add.reduceat(values, self.first[:-1], dtype=np.int64) if len(self) else np.zeros(0, np.int64)


@dataclass
class Words:
    """Where words begin and end, the text each is in, and how many words come before each text."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, block: Block) -> Words:
        space = SPACE[block.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edge = np.concatenate([[0], edge])
        start, end = edge[::2], edge[1::2]  # a block ends with a line feed, so each word has an end
        first = np.searchsorted(start, block.first)
        text = np.repeat(np.arange(len(block)), np.diff(first))
        return cls(start, end, text, first)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, block: Block, lower: bool = False) -> np.ndarray:
        """A hash of the bytes of each word; ``lower``: with A-Z as a-z."""
        up, down = powers(len(block.data) + 1)
        values = (_LOWER_VALUES if lower else _VALUES)[block.data]
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])

    def strong_hashes(self, block: Block, lower: bool = False) -> np.ndarray:
        """A hash of each word, made of the whole word by a function without structure; ``lower``: with A-Z as a-z.

        Equal words are found by their bytes first, so that each is hashed once.
        """
        n = len(self.start)
        if not n:
            return np.zeros(0, np.uint64)
        data = LOWER.astype(np.uint8)[block.data] if lower else block.data
        edges = np.empty(2 * n, np.int32)  # words and what lies between them take turns
        edges[::2], edges[1::2] = self.start, self.end
        slices = pa.Array.from_buffers(pa.binary(), 2 * n - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
        known = slices.dictionary_encode()
        made = b"".join([blake2b(w, digest_size=8).digest() for w in known.dictionary.to_pylist()])
        return np.frombuffer(made, "<u8")[known.indices.to_numpy()[::2]]

    def core_hashes(self, block: Block, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
        """A hash of the lower-cased letters of each word, without what else it holds; 0: no letter.

        For each length in ``prefixes`` also one of the first that many bytes of them; 0: the word has fewer.
        """
        up, down = powers(len(block.data) + 1)
        core = CORE[block.data]
        before = np.zeros(len(block.data) + 1, np.int64)
        np.cumsum(core, out=before[1:])
        total = np.zeros(len(block.data) + 1, np.uint64)
        np.cumsum(_CORE_VALUES[block.data] * up[before[:-1]], out=total[1:])
        first = before[self.start]
        letters = before[self.end] - first
        base, scale = total[self.start], down[first]
        made = [np.where(letters > 0, mix((total[self.end] - base) * scale), 0).astype(np.uint64)]
        place = np.append(np.flatnonzero(core), 0)
        for k in prefixes:
            long = letters >= k
            ends = place[np.where(long, first + k - 1, len(place) - 1)] + 1
            made.append(np.where(long, mix((total[ends] - base) * scale, k), 0).astype(np.uint64))
        return made


def windows(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each run of ``width`` words of a text, and the index of its first word."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.text[: n - width + 1] == words.text[width - 1:])
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total += hashes[at + k] * _MULTIPLIERS[k]
    return mix(total, width), at


def chains(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Like ``windows``, but each word goes through the hash of those before it, so no sum of words stands for another."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.text[: n - width + 1] == words.text[width - 1:])
    total = np.full(len(at), width, np.uint64)
    for k in range(width):
        total = mix(total ^ hashes[at + k], k)
    return total, at


def chained(words: Words, hashes: np.ndarray, text: int) -> np.ndarray:
    """One hash of all words of a text, for texts too short for a chain of some width."""
    row = hashes[words.first[text]:words.first[text + 1]]
    total = np.array([1000 + len(row)], np.uint64)
    for k, word in enumerate(row):
        total = mix(total ^ word, k)
    return total


def whole(words: Words, hashes: np.ndarray, text: int) -> np.ndarray:
    """One hash of all words of a text, for texts too short for a window."""
    row = hashes[words.first[text]:words.first[text + 1]]
    total = (row * _MULTIPLIERS[: len(row)]).sum(dtype=np.uint64)
    return mix(np.array([total], np.uint64), 1000 + len(row))


def blocks(column: pa.Array, size: int = 1 << 18) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of the texts of a column, of about ``size`` bytes together, with the index of the first; null is empty.

    A longer text is alone. Only one run is held in Python at a time.
    """
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield at, [x or b"" for x in column.slice(at, to - at).to_pylist()]
        at = to
