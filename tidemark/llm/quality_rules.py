"""Quality rules: counts of a text against fixed thresholds, and a classifier over hashed n-grams.

The classifier is a logistic regression on hashed words, pairs of words and runs of three and four bytes, each kind as
shares of its number. It is trained on labelled rows and calibrated on rows kept out of training (Platt's
method). A text is kept when it passes the counts and its calibrated probability reaches ``least``.

Null is an empty text: no words, all counts 0, and too short to pass. Without labelled rows, or with one class
only, the probability is the share of good rows (1 without rows), so that the counts alone decide. Rows
that repeat are judged each; only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.sampling import fit_logistic, labelled_sample, logistic
from tidemark.llm.scoring import scored
from tidemark.llm.words import SPACE, Block, Words, chains, mix, windows

WIDTH = 1 << 18
SCALE = 20.0
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTED = np.ones(256, bool)  # bytes that begin a character of a word
COUNTED[SPACE] = False
COUNTED[0x80:0xC0] = False

# Fixed values of the counts.
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words


@dataclass
class RuleModel:
    weights: np.ndarray | None
    beta: np.ndarray
    least: float


def feature_groups(block: Block, words: Words, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashed ids, text of each) for words, pairs of words, runs of three and of four bytes; texts in order."""
    pairs, at = windows(words, hashes, 2)
    made = [
        ((mix(hashes, 21) % np.uint64(WIDTH)).astype(np.int64), words.text),
        ((mix(pairs, 22) % np.uint64(WIDTH)).astype(np.int64), words.text[at]),
    ]
    data, owner = block.data.astype(np.uint32), None
    n = len(data)
    owner = np.repeat(np.arange(len(block)), np.diff(block.first))
    for k in (3, 4):
        if n <= k:
            made.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        x = data[: n - k + 1].copy()
        for i in range(1, k):
            x = (x << np.uint32(8)) | data[i: n - k + 1 + i]
        inside = owner[: n - k + 1] == owner[k - 1:]
        x = (x[inside] + np.uint32(k)) * np.uint32(2654435761)
        made.append((((x ^ (x >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(14)).astype(np.int64), owner[: n - k + 1][inside]))
    return made


def linear(weights: np.ndarray, groups: list[tuple[np.ndarray, np.ndarray]], texts: int) -> np.ndarray:
    total = np.zeros(texts)
    for ids, owner in groups:
        n = np.bincount(owner, minlength=texts)
        total += SCALE * np.bincount(owner, weights[ids], texts) / np.maximum(1, n)
    return total


def train(
    documents: DataFrame, labels: DataFrame, rows: int = 800, max_chars: int = 8000, least: float = 0.5, steps: int = 60
) -> RuleModel:
    """Fit on ``rows`` labelled documents of each class at most, longer than ``max_chars`` only if it has too few others."""
    texts, y, weights = labelled_sample(documents, labels, "quality", rows, max_chars)
    if len(y) == 0 or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 1.0, 1e-4, 1 - 1e-4)
        return RuleModel(None, np.array([0.0, np.log(share / (1 - share))]), least)
    block = Block.of(texts)
    words = Words.of(block)
    parts = []
    for ids, owner in feature_groups(block, words, words.hashes(block)):
        n = np.bincount(owner, minlength=len(y))
        keys, count = np.unique(owner * WIDTH + ids, return_counts=True)
        parts.append((keys // WIDTH, keys % WIDTH, SCALE * count / n[keys // WIDTH]))
    owner, ids, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    aside = np.arange(len(y)) % 5 == 0
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside = np.zeros(len(y), bool)
    own = np.where(aside, 0.0, weights)
    w, bias = np.zeros(WIDTH), 0.0
    sums, bias_sum = np.full(WIDTH, 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(owner, w[ids] * value, len(y)) + bias
        off = own * (logistic(z) - y) / own.sum()
        g = np.bincount(ids, off[owner] * value, WIDTH) + 1e-6 * w
        sums += g * g
        w -= 0.1 * g / np.sqrt(sums)
        g = off.sum()
        bias_sum += g * g
        bias -= 0.1 * g / np.sqrt(bias_sum)
    z = np.bincount(owner, w[ids] * value, len(y))
    check = aside if aside.any() else np.ones(len(y), bool)
    return RuleModel(w.astype(np.float32), fit_logistic(z[check, None], y[check], weights[check]), least)


def judge(model: RuleModel, texts: list[bytes]) -> list[pa.Array]:
    block = Block.of(texts)
    words = Words.of(block)
    hashes = words.hashes(block)
    n_words = words.counts()
    # Runs of three words that occur again in their text; each word of one counts once.
    runs, at = chains(words, words.strong_hashes(block), 3)
    _, inverse, count = np.unique(
        mix(runs + words.text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 31), return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1] if len(at) else at
    marked = np.zeros(len(hashes), bool)
    for k in range(3):
        marked[again + k] = True
    repeated = np.bincount(words.text[marked], minlength=len(texts))
    doubled = []
    for text in texts:
        lines = [x for x in text.split(b"\n") if x.strip()]
        doubled.append(len(lines) - len(set(lines)))
    failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
    z = 0.0 if model.weights is None else linear(model.weights, feature_groups(block, words, hashes), len(texts))
    p = logistic(z * model.beta[0] + model.beta[1]) * np.ones(len(texts))
    counts = [n_words, block.sums(COUNTED[block.data]), block.sums(SYMBOLS[block.data]), np.array(doubled), repeated]
    return [
        *(pa.array(np.asarray(c, np.int64)) for c in counts), pa.array(failed), pa.array(p, pa.float64()),
        pa.array(~failed & (p >= model.least))]


def apply_rules(documents: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id, the counts, base_failed, probability and kept."""
    return scored(
        documents, model, judge,
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "probability double, kept boolean")
