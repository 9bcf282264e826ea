"""Concept vocabularies: tf-idf, co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


WORDS = r"[\p{L}\p{M}\p{N}_]{2,}"  # \b\w\w+\b in every script, with combining marks


def terms(docs: DataFrame, doc: str, text: str, pattern: str = WORDS) -> DataFrame:
    """(doc, term, tf) of the lower-case terms."""
    words = docs.select(doc, F.explode(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))).alias("term"))
    return words.groupBy(doc, "term").agg(F.count("*").alias("tf"))


def tfidf(counts: DataFrame, docs: DataFrame, doc: str) -> DataFrame:
    """(doc, term, score): tf * (ln((1+n)/(1+df)) + 1), rows scaled to length 1."""
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    n = docs.select(doc).distinct().agg(F.count("*").alias("n_docs"))
    raw = counts.join(df, "term").crossJoin(F.broadcast(n))  # one row
    raw = raw.withColumn("w", F.col("tf") * (F.log((1.0 + F.col("n_docs")) / (1.0 + F.col("df"))) + 1))
    norms = raw.groupBy(doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, doc).select(doc, "term", F.round(F.col("w") / F.col("norm"), 6).alias("score"))


def top_terms(scores: DataFrame, doc: str, n: int) -> DataFrame:
    """(doc, term, score, place): the n best terms of each document, alphabetical among equals."""
    order = Window.partitionBy(doc).orderBy(F.desc("score"), "term")
    return scores.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def cooccurrence(rows: DataFrame, doc: str, item: str, least: int = 2) -> DataFrame:
    """(a, b, n): pairs a < b of items that share at least `least` documents, each document counted once."""
    items = rows.select(doc, item).distinct()
    left, right = items.select(doc, F.col(item).alias("a")), items.select(doc, F.col(item).alias("b"))
    pairs = left.join(right, doc).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))
    return pairs.where(F.col("n") >= least)
