"""Crawl states as column expressions: which criterion and page comes next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def next_criterion(index: Column, count: Column, done: Column) -> Column:
    """The next criterion after index, going round, that is not done; null if all are."""
    round_trip = F.transform(F.sequence(F.lit(1), count), lambda k: F.pmod(index + k, count).cast("int"))
    return F.get(F.filter(round_trip, lambda i: ~F.array_contains(done, i)), 0)


def advance(states: DataFrame, now: Column, pause: int) -> DataFrame:
    """States after a page.

    States have (criterion_index, page, done array<int>, repeats array<boolean>, has_more). More pages: the next page.
    Otherwise a criterion that doesn't repeat is done and the next open one starts at page 1; going round to the same or
    an earlier repeating one pauses; null index: everything is done.
    """
    i, n = F.col("criterion_index"), F.size("repeats")
    again = F.element_at("repeats", i + 1)
    done = F.when(F.col("has_more") | again, F.col("done")).otherwise(F.array_union("done", F.array(i)))
    following = next_criterion(i, n, done)
    rows = states.withColumn("_done", done).withColumn("_next", F.when(F.col("has_more"), i).otherwise(following))
    page = F.when(F.col("has_more"), F.col("page") + 1).otherwise(F.lit(1))
    waits = ~F.col("has_more") & again & (F.col("_next") <= i)
    return rows.select(*(c for c in states.columns if c not in ("criterion_index", "page", "done", "resume_at")), F.col("_next").alias("criterion_index"), page.alias("page"), F.col("_done").alias("done"), F.when(waits, now + F.lit(pause)).alias("resume_at"))


def paused(resume_at: Column, now: Column) -> Column:
    """True while the state waits."""
    return F.coalesce(now < resume_at, F.lit(False))
