"""Language identification with averaged hashed subword embeddings and a linear softmax.

A text is lower-cased. Its features are three-byte subwords (everything but letters reads as a space) and whole
words, hashed into one table of embeddings each. The mean embedding of a text goes through a linear layer and a
softmax. Embeddings and layer are trained together by stochastic gradient descent in numpy. A
temperature, fitted on texts kept out of training, calibrates the probabilities; a text is rejected when its
language is less likely than ``least``.

A text that is null or has no letter is ``und`` with score 0 and is rejected. Without training rows everything is.
Equal scores go to the language first in code point order. Rows that repeat are scored each; only doc_id, text (and lang,
in training) are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.sampling import even_sample, measures, remainder
from tidemark.llm.scoring import kept, scored
from tidemark.llm.words import Block, Words, blocks, mix

SUBWORDS, WHOLE = 1 << 16, 1 << 16
_SHOWN = np.full(256, 32, np.uint32)
for _byte in [*range(97, 123), *range(128, 256)]:
    _SHOWN[_byte] = _byte


@dataclass
class LanguageModel:
    """``table`` holds the product of embeddings and layer: a feature adds a row of it to the mean."""

    names: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float


def feature_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The features of all texts one after another, and the number before each text."""
    lowered = [t.decode("utf-8", "replace").lower().encode("utf-8", "surrogatepass") for t in texts]
    block = Block.of(lowered)
    shown = _SHOWN[block.data]
    n = len(shown)
    x = (shown[: n - 2] << np.uint32(16)) | (shown[1: n - 1] << np.uint32(8)) | shown[2:] if n > 2 else np.zeros(0, np.uint32)
    # A subword may not reach past the end of its text, and not be all space.
    inside = np.ones(len(x), bool)
    for back in (0, 1, 2):
        at = block.first[1:] - 1 - back
        inside[at[(at >= 0) & (at < len(x))]] = False
    inside &= x != 0x202020
    at = np.flatnonzero(inside)
    ids = ((x[at] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    words = Words.of(block)
    core = words.core_hashes(block)[0]
    some = core > 0
    word_ids = (mix(core[some], 5) % np.uint64(WHOLE)).astype(np.int64) + SUBWORDS
    place = np.concatenate([at, words.start[some]])
    ids = np.concatenate([ids, word_ids])
    text = np.searchsorted(block.first, place, "right") - 1
    order = np.argsort(text, kind="stable")
    return ids[order], np.searchsorted(text[order], np.arange(len(texts) + 1))


def features_of_all(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``feature_ids`` of many texts, worked out a run at a time, as it takes a hundred bytes for one of a text."""
    parts = [feature_ids(run) for _, run in blocks(pa.array(texts, pa.large_binary()))]
    ids = np.concatenate([part.astype(np.int32) for part, _ in parts])
    return ids, np.concatenate([[0], np.cumsum(np.concatenate([np.diff(first) for _, first in parts]))])


def means(table: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The mean row of the features of each text; zero without features."""
    n = np.diff(first)
    out = np.zeros((len(n), table.shape[1]))
    some = n > 0
    if some.any():
        out[some] = np.add.reduceat(table[ids], first[:-1][some], axis=0) / n[some, None]
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit_embeddings(
    ids: np.ndarray, first: np.ndarray, y: np.ndarray, classes: int, size: int = 16, epochs: int = 8, rate: float = 0.3,
    batch: int = 32, seed: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """Stochastic gradient descent with a step of its own for each weight; gives table and bias."""
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1, 1, (SUBWORDS + WHOLE, size)) / size
    layer, bias = rng.normal(0, 0.1, (size, classes)), np.zeros(classes)
    sums = [np.full(embed.shape, 1e-8), np.full(layer.shape, 1e-8), np.full(classes, 1e-8)]
    target = np.eye(classes)[y]
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            pick = order[at:at + batch]
            pick = pick[first[pick + 1] > first[pick]]
            if not len(pick):
                continue
            parts = [np.unique(ids[first[i]:first[i + 1]], return_counts=True) for i in pick]
            flat = np.concatenate([p[0] for p in parts])
            share = np.concatenate([p[1] / p[1].sum() for p in parts])
            owner = np.repeat(np.arange(len(pick)), [len(p[0]) for p in parts])
            heads = np.searchsorted(owner, np.arange(len(pick)))
            mean = np.add.reduceat(embed[flat] * share[:, None], heads, axis=0)
            off = (softmax(mean @ layer + bias) - target[pick]) / len(pick)
            back = off @ layer.T
            names, where = np.unique(flat, return_inverse=True)
            g = np.zeros((len(names), size))
            np.add.at(g, where, back[owner] * share[:, None])
            sums[0][names] += g * g
            embed[names] -= rate * g / np.sqrt(sums[0][names])
            g = mean.T @ off
            sums[1] += g * g
            layer -= rate * g / np.sqrt(sums[1])
            g = off.sum(axis=0)
            sums[2] += g * g
            bias -= rate * g / np.sqrt(sums[2])
    return embed @ layer, bias


def calibrated(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss."""
    grid = np.geomspace(0.1, 10, 60)
    loss = [-np.log(np.maximum(1e-12, softmax(logits / t)[np.arange(len(y)), y])).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(
    documents: DataFrame, rows: int = 400, max_chars: int = 6000, least: float = 0.5, modulus: int = 5, rest: int = 0
) -> LanguageModel:
    """Fit on ``rows`` documents of each language at most, longer than ``max_chars`` only if it has too few others.

    Documents whose remainder is ``rest``, or without an id, a text or a language, are not used. A fifth of the sample
    is kept for the temperature.
    """
    usable = documents.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("label")).where(
        (remainder(F.col("doc_id"), modulus) != rest) & F.col("lang").isNotNull())
    found = even_sample(documents, usable.select("label", *measures(F.col("text"))), rows, max_chars)
    names = sorted({lang for _, lang in found})
    if not names:
        return LanguageModel([], np.zeros((SUBWORDS + WHOLE, 1), np.float32), np.zeros(1), 1.0, least)
    y = np.array([names.index(lang) for _, lang in found])
    ids, first = features_of_all([t for t, _ in found])
    del found
    aside = np.arange(len(y)) % 5 == 0
    use = np.flatnonzero(~aside) if len(set(y[~aside])) == len(names) else np.arange(len(y))

    def taken(which):
        cut = [ids[first[i]:first[i + 1]] for i in which]
        return np.concatenate(cut) if cut else ids[:0], np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)

    table, bias = fit_embeddings(*taken(use), y[use], len(names))
    rest_ = np.flatnonzero(aside)
    temperature = calibrated(means(table, *taken(rest_)) + bias, y[rest_]) if len(rest_) else 1.0
    return LanguageModel(names, table.astype(np.float32), bias, temperature, least)


def judge(model: LanguageModel, texts: list[bytes]) -> list[pa.Array]:
    readable = np.array([bool(model.names) and any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts], bool)
    p = softmax((means(model.table, *feature_ids(texts)) + model.bias) / model.temperature)
    best = p.argmax(axis=1)
    names = [model.names[b] if ok else "und" for b, ok in zip(best, readable, strict=True)]
    score = np.where(readable, p[np.arange(len(best)), best], 0.0)
    return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(~readable | (score < model.least))]


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, rejected."""
    return scored(documents, model, judge, "lang_pred string, score double, rejected boolean")


def recognised(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents that are not rejected."""
    return kept(documents, model, judge, lambda found: pc.invert(found[2]))
