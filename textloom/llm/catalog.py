"""Queries of the numbered problems, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import garbled_text, languages, mixing, scanned_text, sentences, spam_pages, spelling_groups, tokenize, url_index, vector_graph
from textloom.session import materialize, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return spelling_groups.found(table(spark, d, "raw_node"), table(spark, d, "raw_triplet"))


def p1_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return spelling_groups.collapsed(table(spark, d, "raw_node"), table(spark, d, "raw_triplet"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scanned_text.found(table(spark, d, "chunk"), table(spark, d, "raw_graph"), table(spark, d, "sentence"))


def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scanned_text.repaired(table(spark, d, "chunk"), table(spark, d, "raw_graph"), table(spark, d, "sentence"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return url_index.found(table(spark, d, "custom_query_pdf"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return vector_graph.found(table(spark, d, "clustered_node"), table(spark, d, "clustered_edge"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return garbled_text.found(table(spark, d, "chunk"), table(spark, d, "sentence"))


def p5_restored(spark: SparkSession, d: str) -> DataFrame:
    return garbled_text.restored(table(spark, d, "chunk"), table(spark, d, "sentence"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.found(table(spark, d, "chunk"), table(spark, d, "raw_graph"))


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    return languages.segments(table(spark, d, "chunk"), table(spark, d, "raw_graph"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.found(table(spark, d, "chunk"), table(spark, d, "sentence"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode_corpus(table(spark, d, "documents"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.queue(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_target")
    return mixing.report(materialize(mixing.queue(table(spark, d, "documents"), targets), "mixture"), targets)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam_pages.found(table(spark, d, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p1_collapsed": p1_collapsed,
    "p2_found": p2_found,
    "p2_repaired": p2_repaired,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_restored": p5_restored,
    "p6_found": p6_found,
    "p6_segments": p6_segments,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_mixture": p9_mixture,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
}

SQL: dict[str, str] = {}
