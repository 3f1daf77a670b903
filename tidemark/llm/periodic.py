"""Periodic runs of words: passages that repeat with a period, as in looping text.

A run is a stretch of consecutive words with smallest period q, of at least ``least`` words and ``power`` periods, that no
neighbouring word extends. On the diagonal of lag q, word i meets word i + q; a run is a stretch of equal words there.

Seeds are k-grams. A run of lag q has (power - 1) * q equal words on its diagonal at least, so the lags are covered by
levels: a level with k-grams finds the lags above the k of the level before and up to its own k, and k is the overlap that the
smallest of these lags guarantees. As k is no less than the lag, equal k-grams of a run that follow each other are one smallest period apart: else
the k-gram and the run would have a common smaller period. So only occurrences next to each other are taken as pairs, never all of them, and what
they extend to has no smaller period. k grows threefold, so a text of n words has about log3(n) levels, and a level only looks at k-grams whose parts
occurred twice.

k-grams are numbered exactly: by the words themselves at first, then by the numbers of the parts; a hash only tells which
cannot be equal. Seeds are extended word by word, and a table keeps, by lag, how far the diagonal is covered.

A null text has no words and no runs; null ids, repeated rows and ties keep a row each; an empty table gives none; only doc_id and text are read.
A text is handled whole in one task, in about 150 bytes a word.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.scoring import scored
from tidemark.llm.words import Block, Words, mix

LEAST, POWER = 6, 4
_SALTS = np.random.default_rng(31).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def word_numbers(block: Block, words: Words) -> np.ndarray:
    """A number for each word; equal words have equal numbers."""
    n = len(words.start)
    if not n:
        return np.zeros(0, np.int64)
    edges = np.empty(2 * n, np.int32)  # words and what lies between them take turns
    edges[::2], edges[1::2] = words.start, words.end
    slices = pa.Array.from_buffers(pa.binary(), 2 * n - 1, [None, pa.py_buffer(edges), pa.py_buffer(block.data)])
    return slices.dictionary_encode().indices.to_numpy()[::2].astype(np.int64)


def numbered(*columns: np.ndarray) -> np.ndarray:
    """A number for each row of the columns, from 0; equal rows have equal numbers."""
    number = columns[0]
    for column in columns[1:]:
        number = np.unique(number * (column.max() + 1) + column, return_inverse=True)[1]
    return number


def first_seed(least: int, power: int) -> int:
    """The equal words that a run of any lag has on its diagonal."""
    return min(max(least - q, (power - 1) * q) for q in range(1, least + 1))


def may_repeat(codes: np.ndarray, text: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Those of the places ``at`` whose k-gram may occur again in its text."""
    total = mix(text[at].astype(np.uint64), 2)
    word = mix(codes.astype(np.uint64), 1)
    for j in range(k):
        total += word[at + j] * _SALTS[j % len(_SALTS)]
    order = np.argsort(total, kind="stable")
    same = total[order[1:]] == total[order[:-1]]
    again = np.zeros(len(at), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    return at[again]


def stretch_end(codes: np.ndarray, at: int, lag: int, stop: int) -> int:
    """The first place from ``at`` on whose word differs from the one ``lag`` later, or that has none before ``stop``."""
    size = 64
    while at < stop - lag:
        to = min(at + size, stop - lag)
        differ = np.flatnonzero(codes[at:to] != codes[at + lag:to + lag])
        if len(differ):
            return at + int(differ[0])
        at, size = to, 2 * size
    return at


def stretch_start(codes: np.ndarray, at: int, lag: int, begin: int) -> int:
    """The place after the last one before ``at`` whose word differs from the one ``lag`` later."""
    size = 64
    while at > begin:
        to = max(at - size, begin)
        differ = np.flatnonzero(codes[to:at] != codes[to + lag:at + lag])
        if len(differ):
            return to + int(differ[-1]) + 1
        at, size = to, 2 * size
    return at


def find_runs(codes: np.ndarray, first: np.ndarray, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """Rows (text, start in the text, length, period) of all runs, in order; text t has the words first[t] to first[t + 1]."""
    if power < 3:
        raise ValueError("a run needs three periods or more")
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][text]
    k, shorter = first_seed(least, power), 0
    at = np.flatnonzero(np.arange(len(codes)) + k <= end)
    at = may_repeat(codes, text, at, k)
    number = numbered(text[at], *(codes[at + j] for j in range(k))) if len(at) else at
    covered: dict[int, int] = {}
    runs: list[tuple[int, int, int, int]] = []
    while len(at):
        again = np.bincount(number)[number] > 1
        at, number = at[again], number[again]
        order = np.lexsort((at, number))
        one, two = at[order[:-1]], at[order[1:]]
        lag = two - one
        seed = (number[order[:-1]] == number[order[1:]]) & (lag > shorter) & (lag <= k)
        one, lag = one[seed], lag[seed]
        order = np.lexsort((one, lag))
        one, lag = one[order], lag[order]
        # A seed right after another one of its lag lies in the same stretch.
        new = np.ones(len(one), bool)
        new[1:] = (lag[1:] != lag[:-1]) | (one[1:] != one[:-1] + 1)
        for i, q in zip(one[new].tolist(), lag[new].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            t = text[i]
            covered[q] = stop = stretch_end(codes, i + k, q, int(first[t + 1]))
            start = stretch_start(codes, i, q, int(first[t]))
            if stop - start + q >= max(least, power * q):
                runs.append((t, start - first[t], stop - start + q, q))
        # The grams of the next level, by the numbers of those that cover them.
        wider = (power - 1) * (k + 1)
        place = np.full(len(codes), -1, np.int64)
        place[at] = number
        at = at[at + wider <= end[at]]
        offsets = [*range(0, (power - 1) * k, k), wider - k]
        for offset in offsets:
            at = at[place[at + offset] >= 0]
        number = numbered(*(place[at + offset] for offset in offsets)) if len(at) else at
        k, shorter = wider, k
    found = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def dropped(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The words that some run has after its first period."""
    steps = np.zeros(int(first[-1]) + 1, np.int64)
    begin = first[runs[:, 0]] + runs[:, 1]
    np.add.at(steps, begin + runs[:, 3], 1)
    np.add.at(steps, begin + runs[:, 2], -1)
    return np.cumsum(steps[:-1]) > 0


def judge(model: tuple[int, int], texts: list[bytes]) -> list[pa.Array]:
    """Words, runs and what is left of each text, its words joined by a space."""
    block = Block.of(texts)
    words = Words.of(block)
    runs = find_runs(word_numbers(block, words), words.first, *model)
    keep = ~dropped(runs, words.first)
    has = np.zeros(len(texts), bool)
    has[runs[:, 0]] = True
    left = []
    for t, own in enumerate(texts):
        parts = own.split()
        left.append(b" ".join(compress(parts, keep[words.first[t]:words.first[t + 1]].tolist()) if has[t] else parts))
    ends = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    rows = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
    return [pa.array(words.counts(), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows), pa.array(left, pa.binary())]


def periodic_runs(documents: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """doc_id, n_words, ``runs`` in order of start and period, and ``collapsed``: the words no run repeats, joined by a space."""
    found = scored(documents, (least, power), judge, f"n_words long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def steepest(runs: Column) -> Column:
    """The run of the most periods, exactly; of equal ones the first; null without runs."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))


def listed(runs: Column) -> Column:
    """``start,length,period`` of each run, a line each."""
    return F.array_join(F.transform(runs, lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))), "")
