"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.store import stored

UNITS = 1 << 30


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    return F.coalesce(remainder(doc_id, modulus) == rest, F.lit(False))


def measures(text: Column, seed: int = 7) -> list[Column]:
    """Characters, bytes and two hashes of a text."""
    return [
        F.length(text).alias("chars"), F.octet_length(text).alias("size"), F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(seed), text).alias("h2")]


def even_sample(
    documents: DataFrame, measured: DataFrame, rows: int, max_chars: int, classes: int = 1000
) -> list[tuple[bytes, object]]:
    """``rows`` texts of each value of ``label``, or all there are, picked by a hash of the text, in order.

    ``measured`` has the label and the measures of each text to pick from, ``documents`` has the texts. Equal texts of one label count
    once, others are never left out for being alike. Texts of at most ``max_chars`` come first; a label that has too few of these
    gets longer ones too, the shorter of a random choice first, up to ``rows`` * ``max_chars`` bytes. If it has nothing else and
    its first one is longer than that, it gets the beginning of that one. More than ``classes`` labels are refused.
    """
    found = measured.where(F.col("chars").isNotNull()).withColumn("long", F.col("chars") > max_chars)
    found = stored(found.groupBy("label", "h1", "h2", "long").agg(F.min("size").alias("size")))
    counts = {(r["label"], r["long"]): r["count"] for r in found.groupBy("label", "long").count().limit(2 * classes + 1).collect()}
    values = {value for value, _ in counts}
    if len(values) > classes:
        raise ValueError(f"more than {classes} labels")
    unit = F.pmod(F.col("h2"), F.lit(UNITS))
    picked = F.lit(False)
    for (value, long), n in counts.items():
        need = rows - counts.get((value, False), 0) if long else rows
        if need > 0:  # some more, so that as good as never too few are
            part = min(1.0, (need + 6 * need**0.5 + 10) / n)
            picked = picked | (F.col("label").eqNullSafe(F.lit(value)) & (F.col("long") == long) & (unit < int(UNITS * part)))
    by_label: dict[object, list] = {}
    for r in found.where(picked).collect():  # about 2 * rows a label
        by_label.setdefault(r["label"], []).append(r)
    budget, taken = rows * max_chars, []
    for own in by_label.values():
        own.sort(key=lambda r: (r["long"], r["size"] if r["long"] else r["h2"] % UNITS, r["h2"], r["h1"]))
        held = 0
        for at, r in enumerate(own[:rows]):
            held += r["size"] * r["long"]
            if held > budget and at:
                break
            taken.append((r["label"], r["h1"], r["h2"]))
    if not taken:
        return []
    kind = f"label {measured.schema['label'].dataType.simpleString()}, h1 long, h2 long"
    wanted = F.broadcast(documents.sparkSession.createDataFrame(taken, kind))
    text = F.col("text").cast("string")
    texts = documents.select(text.alias("text"), *measures(text)[2:]).join(wanted, ["h1", "h2"])
    texts = texts.groupBy("label", "h1", "h2").agg(F.first(F.substring("text", 1, budget)).alias("text"))
    return sorted((r["text"].encode()[:max(budget, 4 * max_chars)], r["label"]) for r in texts.collect())


def usable_labels(labels: DataFrame, label: str, modulus: int = 3, rest: int = 1) -> DataFrame:
    """doc_id and label of each id to train on: not of the remainder ``rest``, with a label of 0 or 1; 1 if it has both."""
    usable = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        (remainder(F.col("doc_id"), modulus) != rest) & F.col("label").isin(0, 1))
    return usable.groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, rows: int, max_chars: int, modulus: int = 3, rest: int = 1
) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, labels and weights of a bounded sample of labelled documents.

    Rows whose remainder is ``rest`` are left out, also rows without an id or a label
    of 0 or 1. ``rows`` of each class at most; see ``even_sample`` for ``max_chars`` and equal texts. The
    weight of a row is the share of its class in all labelled rows over that in the sample.
    """
    usable = usable_labels(labels, label, modulus, rest)
    measured = documents.select("doc_id", *measures(F.col("text").cast("string"))).join(usable, "doc_id").drop("doc_id")
    found = even_sample(documents, measured, rows, max_chars)
    texts, y = [t for t, _ in found], np.array([mark for _, mark in found], np.int8)
    shares = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    weights = np.ones(len(y))
    for value, count in shares.items():
        here = (y == value).sum()
        if here:
            weights[y == value] = count / sum(shares.values()) * len(y) / here
    return texts, y, weights


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression, the constant last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = logistic(x @ beta)
        gradient = x.T @ (weights * (p - y)) + penalty * beta
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5 / (np.abs(step).max() + 1e-12))
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta
