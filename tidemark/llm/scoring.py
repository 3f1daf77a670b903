"""Running a fitted model over whole texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import blocks


def scored(documents: DataFrame, model: object, judge: Callable[[object, list[bytes]], list[pa.Array]], columns: str) -> DataFrame:
    """doc_id and what ``judge(model, texts)`` gives for runs of texts; a null text is empty.

    The model is broadcast; its size is fixed by its parameters. Texts are handled some hundred kilobytes at a time.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), *judge(sent.value, texts)], names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, {columns}")


def kept(
    documents: DataFrame, model: object, judge: Callable[[object, list[bytes]], list[pa.Array]],
    decide: Callable[[list[pa.Array]], pa.Array],
) -> DataFrame:
    """The rows of ``documents``, with all their columns, that ``decide`` keeps by what ``judge`` gives."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in blocks(batch.column("text")):
                yield batch.slice(at, len(texts)).filter(decide(judge(sent.value, texts)))

    return documents.mapInArrow(run, documents.schema)
