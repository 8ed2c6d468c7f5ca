"""Helpers: one kind of Python workers an executor."""

from pathlib import Path

import pytest
from pyspark import SparkContext

import corpus_pipeline
from blockfuse.llm import langid
from blockfuse.llm.common import local_table, sampled, with_row_numbers

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_rdd(monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("a small table through an RDD starts further Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", refuse)


def test_small_tables_need_no_python_workers(spark, no_rdd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    numbered = with_row_numbers(docs, "n")
    assert numbered.select("n").distinct().count() == docs.count()
    texts = [r.text for r in sampled(docs.select("text"), "text", 10)]
    assert len(set(texts)) == 10
    labels = spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "toxic as label")
    found = sampled(docs, "text", 10, labels=labels, key="doc_id")
    assert {r[1] for r in found} == {0, 1} and len(found) <= 20


def test_language_id_needs_no_rdd(spark, no_rdd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert langid.identify_documents(docs).count() == docs.count()


def test_local_table(spark, no_rdd):
    rows = [("é", 1 << 40), ("", -1), (None, None)]
    df = local_table(spark, rows, "__f string, __n long")
    assert df.columns == ["__f", "__n"] and [tuple(r) for r in df.collect()] == rows
    assert local_table(spark, [], "a int").count() == 0


def test_every_stage_has_one_environment(spark, monkeypatch):
    """The workers' environment is set before a stage runs, whether or not it reads a table of its own."""
    env = spark.sparkContext.environment
    monkeypatch.setitem(env, "PYTHONPATH", "")
    at = corpus_pipeline._stage(lambda s, docs, d: s.sparkContext.environment["PYTHONPATH"])(spark, None, SF)
    assert str(Path(corpus_pipeline.__file__).resolve().parent) in at.split(":")
