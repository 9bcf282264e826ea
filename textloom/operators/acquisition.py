"""URL queues, claims, reuse, upserts and job states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import url_base


def classify_source(url: Column, patterns: Sequence[tuple[str, str]], default: str = "other") -> Column:
    """Name of the first LIKE pattern that fits (`_` and `%` are wildcards)."""
    out = F.lit(default)
    for name, pattern in reversed(patterns):
        out = F.when(url.like(pattern), F.lit(name)).otherwise(out)
    return out


def download_state(location: Column) -> Column:
    """pending ('' or null), unavailable ('NA') or downloaded."""
    return F.when(F.coalesce(location, F.lit("")) == "", "pending").when(location == "NA", "unavailable").otherwise("downloaded")


def breakdown(rows: DataFrame, key: str, state: str) -> DataFrame:
    """Counts of the three states by key, most downloads first."""
    count = lambda s: F.count_if(F.col(state) == s)
    return rows.groupBy(key).agg(F.count("*").alias("total"), count("downloaded").alias("downloaded"), count("pending").alias("pending"), count("unavailable").alias("unavailable"))


def route(url: Column, rules: Sequence[tuple[str, str]], root: str = "") -> Column:
    """Folder of the last rule whose text the URL contains."""
    out = F.lit(root)
    for text, folder in rules:
        out = F.when(url.contains(text), F.lit(folder)).otherwise(out)
    return out


def reusable(wanted: DataFrame, done: DataFrame, url: str, done_url: str, location: str) -> DataFrame:
    """Each wanted URL with the smallest location under the same base URL, if any is downloaded.

    Joined on the base, so it hashes instead of matching prefixes; duplicates
    of a base are combined before the join.
    """
    kept = done.where(~F.col(location).isin("", "NA")).groupBy(url_base(F.col(done_url)).alias("base")).agg(F.min(location).alias("reuse"))
    return wanted.withColumn("base", url_base(F.col(url))).join(kept, "base", "left")


def append_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows, and of the new ones the first of each key the old don't have."""
    fresh = new.join(old.select(key), key, "left_anti").dropDuplicates([key])
    return old.unionByName(fresh, allowMissingColumns=True)


def upsert_latest(old: DataFrame, new: DataFrame, key: str, guard: str, clock: str) -> DataFrame:
    """Rows by key: an equal guard and a later clock refresh the old row, another guard keeps it, unknown keys are added."""
    best = new.groupBy(key).agg(F.max(F.struct(F.col(clock), F.col(guard))).alias("n"))
    joined = old.join(best, key, "full_outer")
    fresher = F.col(guard).isNotNull() & (F.col(guard) == F.col(f"n.{guard}")) & (F.col(clock) < F.col(f"n.{clock}"))
    known = F.col(guard).isNotNull()
    return joined.select(key, F.when(known, F.col(guard)).otherwise(F.col(f"n.{guard}")).alias(guard), F.when(known & ~fresher, F.col(clock)).otherwise(F.coalesce(F.col(f"n.{clock}"), F.col(clock))).alias(clock), fresher.alias("refreshed"), (~known).alias("added"))


def fair_ranks(rows: DataFrame, source: str, order: Sequence[str | Column], weights: dict[str, int] | None = None) -> DataFrame:
    """Round and place of each row in a weighted round-robin over the sources.

    A source of weight w gives w rows a round. The ranks sort each source; claim()
    cuts the sources to what a claim can take before it ranks them.
    """
    weight = F.lit(1)
    for name, w in (weights or {}).items():
        weight = F.when(F.col(source) == name, F.lit(w)).otherwise(weight)
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy(source).orderBy(*order)))
    return ranked.withColumn("round", F.ceil(F.col("place") / weight).cast("bigint"))


def claim(rows: DataFrame, source: str, order: Sequence[str], n: int, weights: dict[str, int] | None = None) -> DataFrame:
    """The n rows that a fair claim takes: least round first. Each source is cut to n rows before it is ranked."""
    top = Window.partitionBy(source).orderBy(*order)
    few = rows.withColumn("place", F.row_number().over(top)).where(F.col("place") <= n).drop("place")  # a group limit on the map side
    return fair_ranks(few, source, order, weights).orderBy("round", source, "place").limit(n)


def stale_claims(rows: DataFrame, claimed_at: str, now: Column, minutes: int = 5) -> DataFrame:
    """Rows nobody has claimed, or whose claim is too old."""
    return rows.where(F.col(claimed_at).isNull() | (F.col(claimed_at) <= now - F.expr(f"INTERVAL {minutes} MINUTES")))


def job_progress(jobs: DataFrame, files: DataFrame, job_id: str, status: str, states: Sequence[int]) -> DataFrame:
    """Files of each job by state; jobs without files stay with zeros."""
    counts = files.groupBy(job_id).agg(F.count("*").alias("files"), *(F.count_if(F.col(status) == s).alias(f"status_{s}") for s in states))
    return jobs.join(counts, job_id, "left").fillna(0, ["files", *(f"status_{s}" for s in states)])


def finished_jobs(files: DataFrame, job_id: str, status: str, done: int) -> DataFrame:
    """Jobs with at least a file whose files are all done."""
    return files.groupBy(job_id).agg(F.bool_and(F.col(status) == done).alias("all_done"), F.count("*").alias("files")).where("all_done").drop("all_done")


def guarded_transition(rows: DataFrame, status: str, expected: int, to: int) -> DataFrame:
    """Rows whose status is as expected move on; the others stay."""
    return rows.withColumn(status, F.when(F.col(status) == expected, F.lit(to)).otherwise(F.col(status)))


def top_ranked(rows: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of a total order."""
    return rows.orderBy(*order).limit(n)
