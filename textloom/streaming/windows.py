"""Event-time windows over a growing folder of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import shared_dir


def windowed_counts(events: DataFrame, ts: str, key: str, minutes: int, late_minutes: int) -> DataFrame:
    """(window_start, key, n, total); a window is final once the watermark passes its end, later rows of it are dropped and its state is freed."""
    rows = events.withWatermark(ts, f"{late_minutes} minutes")
    counts = rows.groupBy(F.window(ts, f"{minutes} minutes"), key).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counts.select(F.unix_timestamp("window.start").alias("window_start"), key, "n", "total")


def run_to_end(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """The final rows of a stream, drained as far as its source goes now; each batch appends to a table in the shared folder."""
    out, state = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-state")
    query = stream.writeStream.outputMode("append").option("checkpointLocation", state).trigger(availableNow=True)
    query = query.foreachBatch(lambda df, epoch: df.write.mode("overwrite").parquet(f"{out}/{epoch}")).start()
    query.awaitTermination()
    return spark.read.option("recursiveFileLookup", True).schema(stream.schema).parquet(out)


def run_updates(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """Drain a stream in update mode: every batch appends the rows it changed, with its number as `epoch`."""
    out, state = shared_dir(spark, "stream-updates"), shared_dir(spark, "stream-state")
    query = stream.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True)
    query = query.foreachBatch(lambda df, epoch: df.withColumn("epoch", F.lit(epoch).cast("bigint")).write.mode("overwrite").parquet(f"{out}/{epoch}")).start()
    query.awaitTermination()
    return spark.read.option("recursiveFileLookup", True).schema(stream.schema.add("epoch", "long")).parquet(out)


def latest_of(updates: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value) after the last update of each key."""
    return updates.groupBy(*keys).agg(F.max_by(value, "epoch").alias(value))
