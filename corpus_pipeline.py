"""Corpus pipeline: five stages from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread
as the next stage's docs. Work tables of a stage are deleted when the next one begins.

Every row is a document of its own: stages that drop documents know rows by file and place, so rows of one
id or without id are judged each by its own text. Null, empty and blank texts have no letters and go in the
first stage (a later stage that meets them keeps them). Of equal rows one stays, of tied ones that
with the least id (null last). An empty table gives an empty result. Extra columns are carried through;
the last stage's four columns replace those of the same name.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockfuse.llm import decontaminate, jaccard, langid, linededup, mixing
from blockfuse.llm.common import importable, materialize, maybe_broadcast, read_table, release, with_row_numbers, work_scope


def _stage(f):
    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, "pipeline")
        importable(spark)  # before the first Python worker: workers of another environment would be further ones
        with work_scope("pipeline"):
            return f(spark, docs, sf_dir)

    return run_stage


_ROW = "__row"


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs (with row numbers) without the rows in gone (a narrow result, written first)."""
    gone = materialize(gone.select(_ROW), "gone")
    return docs.join(maybe_broadcast(gone, 24), _ROW, "left_anti").drop(_ROW)


@_stage
def language_id(spark, docs, sf_dir):
    """Keeps what is in one of the known languages; rejects texts without letters and noise."""
    return langid.identify_documents(docs).where("accepted").select(*docs.columns)


@_stage
def line_dedup(spark, docs, sf_dir):
    """Drops repeated lines from the texts (n_chars follows); every document stays."""
    out = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


@_stage
def near_duplicates(spark, docs, sf_dir):
    """Of each group of linked documents the one with the smallest id (null last, then the first row) stays."""
    docs = with_row_numbers(docs, _ROW)
    found = materialize(jaccard.near_duplicates(docs, _ROW).where("n_shingles > 0").select(F.col("doc_id").alias(_ROW), "component_id"), "found")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _ROW)
    groups = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    members = found.join(maybe_broadcast(materialize(groups, "groups"), 24), "component_id")
    members = materialize(members, "group_members")
    members = docs.select(_ROW, "doc_id").join(maybe_broadcast(members, 40), _ROW)
    first = members.groupBy("component_id").agg(F.min(place)[_ROW].alias("first"))
    return _without(docs, members.join(first, "component_id").where(F.col("first") != F.col(_ROW)))


@_stage
def decontamination(spark, docs, sf_dir):
    """Drops documents that hold too much of a benchmark."""
    docs = with_row_numbers(docs, _ROW)
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"), _ROW)
    return _without(docs, found.where("contaminated").select(F.col("doc_id").alias(_ROW)))


@_stage
def mix_sources(spark, docs, sf_dir):
    """The mix: documents that it takes, with size, source_size, target and taken (words, with repeats)."""
    return mixing.mix_rows(docs).where("taken > 0")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]

#: The language model of the first stage has no SQL twin; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        with work_scope(scope := f"stage-{uuid.uuid4().hex}"):
            docs = materialize(out, name)
        if before:
            release(spark, before)
        before = scope
    release(spark, "pipeline")
    return docs
