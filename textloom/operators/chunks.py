"""Sentence windows and context windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.places import placed


def window_starts(n: Column, size: Column, overlap: Column) -> Column:
    """Starts 0, step, 2*step ... up to the first window that holds the last sentence; step is at least 1."""
    step = F.greatest(F.lit(1), size - overlap)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), step)
    return F.when(n > 0, F.filter(starts, lambda s: (s == 0) | (s - step + size < n))).otherwise(F.array().cast("array<int>"))


def chunk_windows(rows: DataFrame, sentences: Column, size: Column, overlap: Column, keys: list[str]) -> DataFrame:
    """(keys, chunk, first_sentence, n_sentences, text) of sliding sentence windows."""
    named = rows.select(*keys, sentences.alias("s"), size.cast("int").alias("size"), overlap.cast("int").alias("overlap"))
    starts = named.select(*keys, "s", "size", F.posexplode(window_starts(F.size("s"), F.col("size"), F.col("overlap"))).alias("chunk", "first_sentence"))
    part = F.slice("s", F.col("first_sentence") + 1, F.col("size"))
    return starts.select(*keys, "chunk", "first_sentence", F.size(part).alias("n_sentences"), F.array_join(part, " ").alias("text"))


def neighbour_context(rows: DataFrame, keys: list[str], order: str, text: str, width: int, snippet: int) -> DataFrame:
    """Adds context: the snippets of up to width rows before and after, joined by line ends.

    Rows are numbered in two levels and meet their neighbours by number, so a
    large group is spread over tasks.
    """
    cut = F.when(F.length(text) > snippet, F.concat(F.substring(text, 1, snippet), F.lit("..."))).otherwise(F.col(text))
    numbered = placed(rows, keys, order, "_no")
    steps = [k for k in range(-width, width + 1) if k]
    sent = numbered.select(*keys, F.col("_no").alias("_from"), cut.alias("_cut"), F.explode(F.array(*map(F.lit, steps))).alias("_k")).withColumn("_no", F.col("_from") + F.col("_k"))
    met = sent.groupBy(*keys, "_no").agg(F.array_sort(F.collect_list(F.struct("_from", "_cut"))).alias("_x"))  # at most two widths
    joined = numbered.join(met, [*keys, "_no"], "left")
    return joined.withColumn("context", F.coalesce(F.array_join(F.transform("_x", lambda x: x["_cut"]), "\n"), F.lit(""))).drop("_x", "_no")
