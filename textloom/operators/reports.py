"""Operational reports: totals, outcomes, durations, zero buckets, alerts, token statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Minutes of a run that explain an empty bucket.
STALL = 75
BACKOFF = (10, 20)


def totals(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: n and the number of rows for each condition; like a sum it is null over no rows."""
    return rows.agg(F.count("*").alias("n"), *(F.sum(F.when(c, 1).otherwise(0)).alias(name) for name, c in conditions.items()))


def outcomes(rows: DataFrame, dag: str, conditions: dict[str, Column]) -> DataFrame:
    """(dag, counts): of every dag and, with a null dag, of all."""
    return rows.cube(dag).agg(*(F.count_if(c).alias(name) for name, c in conditions.items()))


def durations(runs: DataFrame, start: str, end: str, now: Column) -> DataFrame:
    """Runs with their minutes; a run without end is still going."""
    return runs.withColumn("minutes", (F.unix_timestamp(F.coalesce(F.col(end), now)) - F.unix_timestamp(start)) / 60.0)


def zero_buckets(buckets: DataFrame, runs: DataFrame, minutes: int) -> DataFrame:
    """(bucket, kind) of the empty buckets: `stall` if a run of STALL minutes or more overlaps, else `benign_backoff` for one of BACKOFF minutes, else `unexplained`.

    buckets (bucket, n), runs (start, end, minutes). Runs are laid out over the
    buckets they touch and joined by equality.
    """
    size = 60 * minutes
    first, last = F.floor(F.unix_timestamp("start") / size), F.floor((F.unix_timestamp("end") - 1) / size)
    cells = runs.where(F.unix_timestamp("end") > F.unix_timestamp("start")).select("minutes", F.explode(F.sequence(first, F.greatest(first, last))).alias("k"))
    rank = F.when(F.col("minutes") >= STALL, 2).when(F.col("minutes").between(*BACKOFF), 1).otherwise(0)
    worst = cells.groupBy("k").agg(F.max(rank).alias("rank"))
    empty = buckets.where("n = 0").select("bucket", F.floor(F.unix_timestamp("bucket") / size).alias("k"))
    kind = F.when(F.col("rank") == 2, "stall").when(F.col("rank") == 1, "benign_backoff").otherwise("unexplained")
    return empty.join(worst, "k", "left").select("bucket", kind.alias("kind"))


def alerts(facts: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """(level, alert) of the rules (level, alert, condition) that hold in a one-row table; (`good`, `none`) if none does."""
    hits = F.filter(F.array(*(F.when(c, F.struct(F.lit(level).alias("level"), F.lit(name).alias("alert"))) for level, name, c in rules)), lambda x: x.isNotNull())
    none = F.array(F.struct(F.lit("good").alias("level"), F.lit("none").alias("alert")))
    return facts.select(F.explode(F.when(F.size(hits) > 0, hits).otherwise(none)).alias("x")).select("x.level", "x.alert")


def token_stats(calls: DataFrame, stage: str, order: str, most: int = 10) -> DataFrame:
    """(stage, calls, input_tokens, output_tokens, failures, errors): errors are the first `most` messages. calls (stage, order, input, output, error)."""
    failed = F.col("error").isNotNull()
    first = calls.where(failed).withColumn("_place", F.row_number().over(Window.partitionBy(stage).orderBy(order))).where(F.col("_place") <= most)
    errors = first.groupBy(stage).agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "error"))), lambda x: x["error"]).alias("errors"))
    sums = calls.groupBy(stage).agg(F.count("*").alias("calls"), F.sum("input").alias("input_tokens"), F.sum("output").alias("output_tokens"), F.count_if(failed).alias("failures"))
    return sums.join(errors, stage, "left").select(stage, "calls", "input_tokens", "output_tokens", "failures", F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))


def lot(key: Column, seed: int) -> Column:
    """A number drawn for a key, the same in every run with the seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sampled(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows drawn at random."""
    return rows.orderBy(lot(F.col(key), seed), key).limit(n)


def random_of_top(rows: DataFrame, order: list[Column], key: str, top: int, seed: int) -> DataFrame:
    """One row drawn among the first `top`."""
    return sampled(rows.orderBy(*order).limit(top), key, 1, seed)
