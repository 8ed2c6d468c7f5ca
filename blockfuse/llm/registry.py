"""Queries and SQL twins of the corpus operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, fingerprint, jaccard, langid, linededup, mixing, pii, toxicity, urlfilter, warc
from .common import read_table
from .oracles import ORACLES


def op1_decontaminate(spark, sf_dir):
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    out = decontaminate.contamination(docs, items)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_url_filter(spark, sf_dir):
    out = urlfilter.classify(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op3_ngram_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_imatch(spark, sf_dir):
    return fingerprint.edited_study(read_table(spark, sf_dir, "documents"))


def op5_fair_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_pii(spark, sf_dir):
    return pii.find(read_table(spark, sf_dir, "documents")).drop("found")


def op7_line_dedup(spark, sf_dir):
    out = linededup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_warc(spark, sf_dir):
    out = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_toxicity(spark, sf_dir):
    out = toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op10_language_id(spark, sf_dir):
    """Documents (with doc_id) and pages (with page_id), each with the evidence that it has."""
    docs = langid.identify_documents(read_table(spark, sf_dir, "documents"))
    pages = langid.identify_pages(read_table(spark, sf_dir, "pages"))
    out = F.col("lang_id"), F.round("lang_posterior", 6).alias("lang_posterior"), F.col("accepted")
    none = F.lit(None).cast("long")
    return docs.select("doc_id", none.alias("page_id"), *out).unionByName(
        pages.select(none.alias("doc_id"), "page_id", *out)
    )


def queries():
    found = (
        op1_decontaminate,
        op2_url_filter,
        op3_ngram_jaccard,
        op4_imatch,
        op5_fair_mixing,
        op6_pii,
        op7_line_dedup,
        op8_warc,
        op9_toxicity,
        op10_language_id,
    )
    return {f.__name__: f for f in found}


def oracle_sql():
    return dict(ORACLES)
