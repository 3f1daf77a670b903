"""Toxic spans and document scores from a linear-chain conditional random field over words.

Labels are given for documents. Words, or beginnings of words, that occur in clearly more toxic documents than
chance allows are listed; the documents are counted by Spark over the whole texts of all labelled training rows. What clear
means is chosen on training rows too: each half is judged by the words that the other half lists. Listed words
are labelled toxic inside toxic documents, every other word is not; on these labelled tokens of a bounded sample the
field is trained. Its features are hashes of the letters of a word (two tables), of its beginnings, so that
inflected forms are known too, of its neighbours, and whether the word and its beginnings are listed, so that listed words which the
sample lacks are known; features are left out at random in training. The marginals of forward and backward messages over a whole text give the toxic words,
joined to spans, and a document score: a logistic regression on the largest marginal and on the
expected number of toxic words.

Null and empty texts have no words; they get the score of a text without toxic words and no spans. Without labelled
rows, or with one class only, every score is the share of toxic rows (0.5 without rows). Rows that repeat are scored
each; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.crf import Crf, fit
from tidemark.llm.sampling import fit_logistic, labelled_sample, logistic, usable_labels
from tidemark.llm.scoring import scored
from tidemark.llm.store import stored
from tidemark.llm.url_filter import Cascade, build
from tidemark.llm.words import Block, Words, blocks, mix

WIDTH = 1 << 18
PREFIXES = (4, 5, 6, 7)  # bytes of a word's beginning
CELLS = ["a0", "a1", "b0", "b1"]  # toxic, then other documents, of each half
# Likelihood ratio, and ratio of the frequencies for a word and for a beginning; the strictest first.
BOUNDS = [(g, *r) for g in (30.0, 20.0, 14.0, 10.0) for r in ((8.0, 20.0), (4.0, 8.0), (2.0, 4.0))]
MOST_LABELLED = 1 << 26  # ids in cascades of some bits each; of more, texts are joined with their labels
MOST_LISTED = 1 << 21  # 100 MB with their counts on the driver, 16 MB in the model


@dataclass
class ToxicModel:
    crf: Crf | None
    beta: np.ndarray
    listed: list[np.ndarray] = field(default_factory=list)


def features(block: Block, words: Words, listed: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed ids of each word, the last by which of the word and its beginnings are listed, and dense features."""
    hashes = words.core_hashes(block, PREFIXES)
    ids = [_bucket(h, 11 + k) for k, h in enumerate([hashes[0], *hashes])]
    own, before, after = ids[0], np.zeros(len(hashes[0]), np.int64), np.zeros(len(hashes[0]), np.int64)
    if len(own) > 1:
        same = words.text[1:] == words.text[:-1]
        before[1:] = np.where(same, own[:-1], 0)
        after[:-1] = np.where(same, own[1:], 0)
    dense = np.column_stack([np.ones(len(own)), hashes[0] == 0]).astype(float)
    return [*ids, before, after, which_listed(hashes, listed)], dense


def _bucket(hashes: np.ndarray, salt: int) -> np.ndarray:
    return np.where(hashes > 0, mix(hashes, salt) % np.uint64(WIDTH - 1) + np.uint64(1), 0).astype(np.int64)


def which_listed(hashes: list[np.ndarray], listed: list[np.ndarray]) -> np.ndarray:
    """For each word a bit for itself and for each beginning that is listed; the lists are in order."""
    bits = np.zeros(len(hashes[0]), np.int64)
    for k, (own, names) in enumerate(zip(hashes, listed, strict=True)):
        if len(names):
            bits |= (names[np.minimum(np.searchsorted(names, own), len(names) - 1)] == own).astype(np.int64) << k
    return bits


def _hashed(doc_id: Column) -> list[Column]:
    return [F.xxhash64(F.lit(41), doc_id).alias("h1"), F.xxhash64(F.lit(43), doc_id).alias("h2")]


def document_frequencies(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """kind (0 a word, k its k-th beginning), word and in how many labelled training rows it is, by label and half.

    Whole texts of all rows count, equal texts in the same half. The rows of kind -1 add up to the numbers of documents.
    """
    usable = stored(usable_labels(labels, label))
    text = F.col("text").cast("string")
    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        *_hashed(F.col("doc_id")), (F.crc32(text) % 2).cast("int").alias("half"), text.alias("text"))
    if usable.count() <= MOST_LABELLED:
        # Exact over all ids, so no text is moved to its label: which rows are labelled, and which of these are toxic.
        named = usable.select(*_hashed(F.col("doc_id")), "label")
        levels = build(named, documents.select(*_hashed(F.col("doc_id")))).levels, build(named.where("label = 1"), named).levels
    else:
        levels = None
        rows = rows.join(usable.select(*_hashed(F.col("doc_id")), "label"), ["h1", "h2"])
    sent = documents.sparkSession.sparkContext.broadcast(levels)

    def cells_of(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
        """The labelled rows of a batch, and the cell each counts in."""
        if sent.value is None:
            toxic = batch.column("label").to_numpy() == 1
        else:
            member, positive = (Cascade(x) for x in sent.value)
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            known = member.contains(h1, h2)
            batch, toxic = batch.filter(pa.array(known)), positive.contains(h1[known], h2[known])
        return batch, 2 * (~toxic).astype(np.int64) + batch.column("half").to_numpy()

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        kind, word, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((word, kind))
        kind, word, count = kind[order], word[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (word[1:] != word[:-1])]))
        return kind[first], word[first], np.add.reduceat(count, first, axis=0)

    def batch_of(kind: np.ndarray, word: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(word.view(np.int64)), *(pa.array(np.ascontiguousarray(c)) for c in count.T)], ["kind", "word", *CELLS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            batch, cells = cells_of(batch)
            for at, texts in blocks(batch.column("text")):
                own = cells[at:at + len(texts)]
                block = Block.of(texts)
                words = Words.of(block)
                parts.append((np.array([-1], np.int32), np.zeros(1, np.uint64), np.bincount(own, minlength=4)[None].astype(np.int64)))
                for k, hashes in enumerate(words.core_hashes(block, PREFIXES)):
                    _, first = np.unique(mix(hashes ^ mix(words.text.astype(np.uint64), 3), 4), return_index=True)  # once for each text
                    first = first[hashes[first] > 0]
                    names, inverse = np.unique(hashes[first], return_inverse=True)
                    count = np.bincount(inverse * 4 + own[words.text[first]], minlength=4 * len(names)).reshape(-1, 4)
                    parts.append((np.full(len(names), k, np.int32), names, count))
                held += sum(len(p[0]) for p in parts[-6:])
                if held > 1 << 19:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > 1 << 18:
                        yield batch_of(*parts[0])
                        parts, held = [], 0
        if parts:
            yield batch_of(*merged(parts))

    kind = "kind int, word long, " + ", ".join(f"{c} long" for c in CELLS)
    return rows.mapInArrow(run, kind).groupBy("kind", "word").agg(*(F.sum(c).alias(c) for c in CELLS))


def clear(a, b, na: int, nb: int, ratio, least: float, log=np.log, where=np.where):
    """Whether document frequencies are ``ratio`` times higher in toxic texts, by a likelihood ratio of ``least``.

    Of arrays, or of columns with the functions of Spark.
    """
    if not na or not nb:
        return a < 0
    p = (a + b) / float(na + nb)
    p = where(p > 0, p, 1.0)
    g = 2.0 * (where(a > 0, a * log(where(a > 0, a, 1) / (na * p)), 0.0) + where(b > 0, b * log(where(b > 0, b, 1) / (nb * p)), 0.0))
    return (g >= least) & ((a + 0.5) / float(na + 1) > ratio * ((b + 0.5) / float(nb + 1)))


def candidates(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of documents, and kind, hash and counts of all words that the widest bounds list, by a half or by both.

    More than ``MOST_LISTED`` are refused.
    """
    total = np.array([list(counts.where("kind < 0").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in CELLS)).first())]).reshape(4)
    least, word, beginning = (min(x) for x in zip(*BOUNDS, strict=True))
    ratio = F.when(F.col("kind") == 0, word).otherwise(beginning)

    def where(test: Column, yes, no) -> Column:
        return F.when(test, yes).otherwise(no)

    fits = F.lit(False)
    for halves in ((0,), (1,), (0, 1)):
        a, b = (sum((F.col(f"{side}{h}") for h in halves), F.lit(0)) for side in "ab")
        na, nb = (int(sum(total[at + h] for h in halves)) for at in (0, 2))
        fits = fits | clear(a, b, na, nb, ratio, least, F.log, where)
    found = counts.where("kind >= 0").where(fits).limit(MOST_LISTED + 1).toArrow()
    if len(found) > MOST_LISTED:
        raise ValueError(f"more than {MOST_LISTED} words and beginnings are clearly toxic")
    columns = [found.column(c).to_numpy() for c in ("kind", "word", *CELLS)]
    return total, columns[0], columns[1].astype(np.int64).view(np.uint64), np.column_stack(columns[2:]).astype(np.int64)


def listed_words(
    total: np.ndarray, kind: np.ndarray, word: np.ndarray, count: np.ndarray, halves: tuple[int, ...], bounds: tuple[float, float, float]
) -> list[np.ndarray]:
    """The listed words, then beginnings of each length, in order, by the counts of one half or of both."""
    a, b = (sum(count[:, at + h] for h in halves) for at in (0, 2))
    na, nb = (int(sum(total[at + h] for h in halves)) for at in (0, 2))
    fits = clear(a, b, na, nb, np.where(kind == 0, bounds[1], bounds[2]), bounds[0])
    return [np.sort(word[fits & (kind == k)]) for k in range(len(PREFIXES) + 1)]


def best_bounds(
    found: tuple[np.ndarray, ...], hashes: list[np.ndarray], text: np.ndarray, half: np.ndarray, y: np.ndarray
) -> tuple[float, float, float]:
    """The bounds by which sampled texts of each half are told apart best by a listed word of the other half; ties: the strictest."""
    best = []
    for bounds in BOUNDS:
        hit = np.zeros(len(y), bool)
        for own in (0, 1):
            bits = which_listed(hashes, listed_words(*found, (1 - own,), bounds))
            hit |= (np.bincount(text, bits > 0, len(y)) > 0) & (half == own)
        best.append(hit[y == 1].mean() - hit[y == 0].mean())
    return BOUNDS[int(np.argmax(best))]


def document_features(p: np.ndarray, words: Words) -> np.ndarray:
    n = len(words.first) - 1
    largest, total = np.zeros(n), np.zeros(n)
    np.maximum.at(largest, words.text, p)
    np.add.at(total, words.text, p)
    return np.column_stack([largest, np.log1p(total)])


def marginal(model: ToxicModel, block: Block, words: Words) -> np.ndarray:
    if model.crf is None or not len(words.start):
        return np.zeros(len(words.start))
    ids, dense = features(block, words, model.listed)
    return model.crf.marginals(ids, dense, words.first)


def train(documents: DataFrame, labels: DataFrame, rows: int = 800, max_chars: int = 6000, steps: int = 30) -> ToxicModel:
    """List words by all labelled training rows; fit on ``rows`` of each class at most, longer than ``max_chars`` only if it has too few others."""
    texts, y, weights = labelled_sample(documents, labels, "toxic", rows, max_chars)
    share = float((weights * y).sum() / max(1e-9, weights.sum())) if len(y) else 0.5
    constant = ToxicModel(None, np.array([0, 0, np.log(np.clip(share, 1e-4, 1 - 1e-4) / (1 - np.clip(share, 1e-4, 1 - 1e-4)))]))
    if len(y) == 0 or y.min() == y.max():
        return constant
    block = Block.of(texts)
    words = Words.of(block)
    found = candidates(stored(document_frequencies(documents, labels).where("a0 + a1 > 0 OR kind < 0")))
    hashes = words.core_hashes(block, PREFIXES)
    half = np.array([zlib.crc32(t) & 1 for t in texts])
    listed = listed_words(*found, (0, 1), best_bounds(found, hashes, words.text, half, y))
    ids, dense = features(block, words, listed)
    marks = (ids[-1] > 0) & (y[words.text] == 1)
    if not marks.any():
        return constant
    # What is listed begins with its log odds, as a listed word that the sample lacks has nothing else.
    patterns = 2 << len(PREFIXES)
    yes, total = np.bincount(ids[-1], marks, patterns), np.bincount(ids[-1], minlength=patterns)
    odds = np.log((yes + 0.5) / (total - yes + 0.5))
    odds[total == 0] = odds[1:][total[1:] > 0].mean()
    tables = [np.zeros(WIDTH) for _ in ids]
    tables[-1][:patterns] = np.clip(odds, -4, 6)
    crf = fit(
        ids, dense, words.first, marks.astype(int), WIDTH, np.ones(len(marks)), steps=steps, keep=0.5, together=len(hashes) + 1,
        model=Crf(tables, np.zeros(dense.shape[1])))
    crf.tables = [t.astype(np.float32) for t in crf.tables]
    seen = document_features(crf.marginals(ids, dense, words.first), words)
    return ToxicModel(crf, fit_logistic(seen, y, weights), listed)


def judge(model: ToxicModel, texts: list[bytes]) -> list[pa.Array]:
    """Score and spans of each text; a span is (start, end, probability) in code points."""
    block = Block.of(texts)
    words = Words.of(block)
    p = marginal(model, block, words)
    score = logistic(document_features(p, words) @ model.beta[:-1] + model.beta[-1])
    points = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=points[1:])
    spans: list[list[dict]] = [[] for _ in texts]
    last = -2
    for i in np.flatnonzero(p >= 0.5):
        own = spans[words.text[i]]
        end = int(points[words.end[i]] - points[block.first[words.text[i]]])
        if i == last + 1 and own and words.text[last] == words.text[i]:
            own[-1]["end"], own[-1]["probability"] = end, max(own[-1]["probability"], float(p[i]))
        else:
            start = int(points[words.start[i]] - points[block.first[words.text[i]]])
            own.append({"start": start, "end": end, "probability": float(p[i])})
        last = i
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))
    return [pa.array(score, pa.float64()), pa.array(spans, kind)]


def score_toxicity(documents: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score, spans."""
    return scored(documents, model, judge, "score double, spans array<struct<start:bigint,end:bigint,probability:double>>")
