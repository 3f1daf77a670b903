"""Registered queries of the subpackage: against SQL, on held-out rows, and the stages of the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import queries

TABLES = "documents embeddings pages labels conversations benchmark".split()


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, data, key):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    frame = queries.queries()[key](spark, data)
    found = connection.execute(queries.oracle_sql()[key])
    names = [column[0] for column in found.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r)) for r in frame.select(*names).collect())


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for key, label, least in (("op5_toxicity", "toxic", 0.93), ("op6_quality", "quality", 0.97)):
        held = queries.queries()[key](spark, folder).where("held_out").join(labels, "doc_id")
        assert held.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0] >= least
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = queries.queries()["op7_language"](spark, folder).where("held_out").join(documents, "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.98


def test_pipeline_stages(spark, data):
    docs = given = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data).cache()
        assert docs.count() > 0.5 * given.count(), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == given.columns
            assert (docs.distinct() if "mixing" in name else docs).exceptAll(given).isEmpty()  # a mix repeats rows
    assert docs.where("NOT round_trip").isEmpty()
