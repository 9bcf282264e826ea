"""Time buckets with gaps filled, interval overlaps, trailing windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_counts(rows: DataFrame, ts: str, minutes: int) -> DataFrame:
    """(bucket, n) of the buckets that have rows."""
    start = F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / (60 * minutes)) * 60 * minutes)
    return rows.groupBy(start.alias("bucket")).agg(F.count("*").alias("n"))


def filled_buckets(rows: DataFrame, ts: str, minutes: int) -> DataFrame:
    """(bucket, n) from the first to the last row, with empty buckets as 0."""
    counts = bucket_counts(rows, ts, minutes)
    spine = counts.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).where("a is not null")
    spine = spine.select(F.explode(F.expr(f"sequence(a, b, interval {minutes} minutes)")).alias("bucket"))
    return spine.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def runs_of(rows: DataFrame, key: str, ts: str, gap_minutes: int) -> DataFrame:
    """(key, start, end, n): runs of rows of a key with no gap of more than gap_minutes."""
    w = F.session_window(ts, f"{gap_minutes} minutes")
    return rows.groupBy(key, w.alias("w")).agg(F.count("*").alias("n"), F.min(ts).alias("start"), F.max(ts).alias("end")).select(key, "start", "end", "n")


def overlaps(runs: DataFrame, buckets: DataFrame, minutes: int) -> DataFrame:
    """(bucket, n_runs, covered_s): the runs that overlap each bucket.

    A run is laid out over the buckets it touches and joined by equality, so no
    pairs of all runs and buckets are formed.
    """
    size = 60 * minutes
    first, last = F.floor(F.unix_timestamp("start") / size), F.floor(F.unix_timestamp("end") / size)
    cells = runs.select("start", "end", F.explode(F.sequence(first, last)).alias("k"))
    low, high = F.col("k") * size, (F.col("k") + 1) * size
    covered = F.least(F.unix_timestamp("end"), high) - F.greatest(F.unix_timestamp("start"), low)
    sums = cells.groupBy("k").agg(F.count("*").alias("n_runs"), F.sum(covered).alias("covered_s"))
    keyed = buckets.withColumn("k", F.floor(F.unix_timestamp("bucket") / size))
    return keyed.join(sums, "k", "left").select("bucket", F.coalesce("n_runs", F.lit(0)).alias("n_runs"), F.coalesce("covered_s", F.lit(0)).alias("covered_s"))


def trailing(rows: DataFrame, ts: str, now: Column, hours: int) -> DataFrame:
    """Rows of the last hours before now; null times are left out."""
    return rows.where(F.col(ts) >= now - F.expr(f"INTERVAL {hours} HOURS"))
