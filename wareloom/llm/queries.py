"""Queries of the text operators, one per operator and one for the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from wareloom.llm import (
    divergence,
    fill_middle,
    fingerprints,
    histogram_shards,
    html_text,
    line_crf,
    min_max,
    mixing,
    packing,
    pitman_yor,
    quality_rules,
    sanitise,
    separator_scan,
)
from wareloom.llm.common import importable, read_table

END_OF_TEXT = 49407
SHARDS = 24


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return separator_scan.count_documents(docs, packing.vocabulary_path(), END_OF_TEXT)


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select(
        "doc_id", "source", mixing.word_tokens(F.col("text")).alias("n_tokens"), "epoch", "block", "block_order", "weight"
    )


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edit(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, packing.vocabulary_path(), payload=F.crc32("ids").alias("ids_crc32"))


def op5_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.find_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return pitman_yor.score_documents(docs, held_out)


def op8_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return min_max.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract_pages(read_table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = line_crf.score_documents(docs, line_crf.train(docs, labels))
    return scored.select(
        "doc_id",
        (line_crf.fold(F.col("doc_id")) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards.shard_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)


def op12_displacement_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_transducer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents").select("lang", "source", "text"))


OPERATORS = (
    op1_separator_scan,
    op2_temperature_mixing,
    op3_document_fingerprints,
    op4_best_fit_packing,
    op5_sanitisation,
    op6_quality_rules,
    op7_pitman_yor,
    op8_min_max,
    op9_html_text,
    op10_quality_classifier,
    op11_histogram_sort,
    op12_displacement_scatter,
    op13_transducer_audit,
)


def prepared(run):
    return lambda spark, sf_dir: run(importable(spark), sf_dir)


QUERIES = {run.__name__: prepared(run) for run in OPERATORS} | {"pipeline": corpus_pipeline.run}
ORACLES = {
    "op11_histogram_sort": histogram_shards.oracle(SHARDS),
    "op12_displacement_scatter": fill_middle.ORACLE,
    "op13_transducer_audit": divergence.ORACLE,
}
