"""Document quality from a linear-chain conditional random field over lines.

Every line with a word gets features of its own and of the lines before and after: shares of kinds of characters, words
equal to one of the three words before, lengths. The field labels a line good or bad. Labels are given for documents;
training starts with the label of the document on every line, then lines of bad documents that the field finds good are
relabelled and it is trained again. The score of a document is a logistic regression on the mean marginal
of "good" over its lines, weighted by length in bytes.

Null and empty texts, and texts without words, have no lines; they count as bad. Without labelled rows, or with one
class only, the score is the share of good rows (0.5 without rows). Rows that repeat are scored each; only
doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.crf import Crf, fit
from tidemark.llm.sampling import fit_logistic, labelled_sample, logistic
from tidemark.llm.scoring import kept, scored
from tidemark.llm.words import Block, Words, blocks

KINDS = 9
_KIND = np.full(256, 8, np.int64)
for _kind, _members in enumerate([
        range(97, 123), range(65, 91), range(48, 58), b" \t\r\n\x0b\x0c", b"|", b"!", b"#*$%&<>@~^_=+", b".,;:?'\"()-"]):
    _KIND[list(_members)] = _kind


@dataclass
class Lines:
    """Features of each line with a word, its text, its length, and the lines before each text."""

    dense: np.ndarray
    text: np.ndarray
    size: np.ndarray
    first: np.ndarray


@dataclass
class LineModel:
    crf: Crf | None
    beta: np.ndarray


def lines_of(texts: list[bytes]) -> Lines:
    block = Block.of(texts)
    words = Words.of(block)
    ends = np.flatnonzero(block.data == 10)
    line = np.zeros(len(block.data), np.int64)  # the line of each byte; its line feed belongs to it
    line[1:] = np.cumsum(block.data[:-1] == 10)
    n = len(ends)
    counts = np.bincount(line * KINDS + _KIND[block.data], minlength=n * KINDS).reshape(n, KINDS).astype(float)
    size = np.diff(ends, prepend=-1) - 1
    hashes = words.hashes(block)
    again = np.zeros(len(hashes))
    for lag in (1, 2, 3):
        if len(hashes) > lag:
            same = (hashes[lag:] == hashes[:-lag]) & (words.text[lag:] == words.text[:-lag])
            again[lag:] = np.maximum(again[lag:], same)
    of_word = line[words.start]
    n_words = np.bincount(of_word, minlength=n)
    repeats = np.bincount(of_word, again, n)
    keep = n_words > 0
    text = np.searchsorted(block.first, ends, "right") - 1
    own = np.sqrt(counts[keep] / np.maximum(1, size[keep, None]))
    extra = np.column_stack([
        np.sqrt(repeats[keep] / n_words[keep]), np.log1p(size[keep]) / 5, size[keep] / n_words[keep] / 10])
    own = np.column_stack([own, np.minimum(extra, 3)])
    text, size = text[keep], size[keep]
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    before, after = np.zeros_like(own), np.zeros_like(own)
    if len(own) > 1:
        same = (text[1:] == text[:-1])[:, None]
        before[1:], after[:-1] = own[:-1] * same, own[1:] * same
    return Lines(np.column_stack([own, before, after, np.ones(len(own))]), text, size, first)


def lines_of_all(texts: list[bytes]) -> Lines:
    """``lines_of`` many texts, worked out a run at a time, as it takes a hundred bytes for one of a text."""
    parts = [(at, lines_of(run)) for at, run in blocks(pa.array(texts, pa.large_binary()))]
    text = np.concatenate([part.text + at for at, part in parts])
    return Lines(
        np.concatenate([part.dense for _, part in parts]), text, np.concatenate([part.size for _, part in parts]),
        np.searchsorted(text, np.arange(len(texts) + 1)))


def good_share(p: np.ndarray, lines: Lines) -> np.ndarray:
    """Mean marginal of each text, weighted by the length of lines; 0 without lines."""
    n = len(lines.first) - 1
    weight = np.bincount(lines.text, lines.size, n)
    return np.bincount(lines.text, lines.size * p, n) / np.maximum(1e-9, weight)


def train(documents: DataFrame, labels: DataFrame, rows: int = 1500, max_chars: int = 20_000, rounds: int = 3) -> LineModel:
    """Fit on ``rows`` labelled documents of each class at most, longer than ``max_chars`` only if it has too few others."""
    texts, y, weights = labelled_sample(documents, labels, "quality", rows, max_chars)
    share = np.clip((weights * y).sum() / max(1e-9, weights.sum()) if len(y) else 0.5, 1e-4, 1 - 1e-4)
    if len(y) == 0 or y.min() == y.max():
        return LineModel(None, np.array([0.0, np.log(share / (1 - share))]))
    lines = lines_of_all(texts)
    marks = y[lines.text].astype(int)
    crf = None
    for turn in range(rounds):  # lines are told apart by themselves first, as no text is mixed before they are relabelled
        crf = fit([], lines.dense, lines.first, marks, 1, weights[lines.text], steps=120, rate=0.3, model=crf, chained=turn > 0)
        p = crf.marginals([], lines.dense, lines.first)
        marks = np.where(y[lines.text] == 1, 1, (p > 0.5).astype(int))
        # A bad document keeps its worst line bad.
        worst = np.lexsort((p, lines.text))
        heads = worst[lines.first[:-1][np.diff(lines.first) > 0]]
        marks[heads] = np.where(y[lines.text[heads]] == 1, 1, 0)
    shares = good_share(crf.marginals([], lines.dense, lines.first), lines)
    return LineModel(crf, fit_logistic(shares[:, None], y, weights))


def judge(model: LineModel, texts: list[bytes]) -> list[pa.Array]:
    """Score of each text, and for each line with a word its marginal."""
    lines = lines_of(texts)
    p = model.crf.marginals([], lines.dense, lines.first) if model.crf and len(lines.text) else np.zeros(len(lines.text))
    score = logistic(good_share(p, lines) * model.beta[0] + model.beta[1])
    marks = pa.ListArray.from_arrays(pa.array(lines.first, pa.int32()), pa.array(p, pa.float64()))
    return [pa.array(score, pa.float64()), marks]


def score_quality(documents: DataFrame, model: LineModel) -> DataFrame:
    """doc_id, score, and ``lines``: the probability that a line is good, for each line with a word."""
    return scored(documents, model, judge, "score double, lines array<double>")


def good(documents: DataFrame, model: LineModel, least: float = 0.5) -> DataFrame:
    """The documents that score ``least`` or more."""
    return kept(documents, model, judge, lambda found: pc.greater_equal(found[0], least))
