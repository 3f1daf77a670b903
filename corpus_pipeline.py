"""A corpus pipeline: each stage is one operator and works on all that the stage before kept.

Stages take (spark, docs, sf_dir) and return a frame; it is written as Parquet and read again as the next
one's documents. All but the last return the columns of documents. Language and quality filters are trained on the
given tables of ``sf_dir``, never on what an earlier stage left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, language, line_quality, mixing, near_dup
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.store import stored

LEAST_QUALITY = 0.5

# Whole rows go through Python and are written by every stage. Smaller Arrow batches and row groups bound what a task holds of them.
SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20), "parquet.block.size": str(32 << 20)}


def _modest(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _modest(spark).read.parquet(f"{sf_dir}/documents.parquet")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter, or of an unsure language, go."""
    return language.recognised(docs, language.train(_documents(spark, sf_dir)))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good; the others go."""
    model = line_quality.train(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_quality.good(docs, model, LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words to a shingle, a similarity of 0.8."""
    _modest(spark)
    return near_dup.without_near_duplicates(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; what it does not take goes."""
    _modest(spark)
    return mixing.repeated(docs, mixing.mix(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the token ids of the text, their number, and whether they decode to it."""
    _modest(spark)
    path = tokenizer_path()
    known = docs.select("doc_id", "lang", "source", F.crc32(F.coalesce("text", F.lit(""))).alias("crc"), "text")
    rows = bpe.decoded(stored(bpe.encoded(known, path)), path)  # written, so that a task runs one Python function
    return rows.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.crc32("decoded") == F.col("crc")).alias("round_trip"))


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_texts),
]

# SQL has no trained models, no seeded choice and no merges. The tests hold run() against single operators for the filters, all
# pairs of texts for near copies, water-filling in plain Python for the mix, and the tokenizer's library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
