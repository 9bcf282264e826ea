"""Numbers of rows within groups, in two levels, so that no group is sorted in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1 << 16


def placed(rows: DataFrame, keys: list[str], order: str, name: str, width: int = WIDTH) -> DataFrame:
    """Adds the number (from 0) of each row of a group in the order of an integer column without ties.

    A group is cut into ranges of the order; ranges are counted, the counts
    summed up, and rows numbered within their range only.
    """
    cut = rows.withColumn("_range", F.floor(F.col(order) / width))
    sizes = cut.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = cut.join(starts, [*keys, "_range"])
    return joined.withColumn(name, F.col("_before") + F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(order)) - 1).drop("_before", "_range")


def running_best(rows: DataFrame, asked: DataFrame, key: str, order: str, value: str, width: int = WIDTH) -> DataFrame:
    """asked with the largest `value` of the group's rows before it in `order` (null without one), in two levels like placed()."""
    cut = lambda df: df.withColumn("_range", F.floor(F.col(order) / width))
    held, wanted = cut(rows.select(key, order, value)), cut(asked)
    tops = held.groupBy(key, "_range").agg(F.max(value).alias("_top"))
    both = tops.unionByName(wanted.select(key, "_range").distinct(), allowMissingColumns=True).groupBy(key, "_range").agg(F.max("_top").alias("_top"))
    earlier = both.withColumn("_earlier", F.max("_top").over(Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))).drop("_top")
    marked = held.withColumn("_asked", F.lit(0)).unionByName(wanted.select(key, order, "_range", F.lit(1).alias("_asked")).distinct(), allowMissingColumns=True)
    within = Window.partitionBy(key, "_range").orderBy(order, F.desc("_asked")).rowsBetween(Window.unboundedPreceding, 0)
    inner = marked.withColumn("_inner", F.max(value).over(within)).where("_asked = 1").select(key, order, "_inner")
    joined = wanted.join(earlier, [key, "_range"], "left").join(inner, [key, order], "left")
    return joined.withColumn(value, F.greatest("_earlier", "_inner")).drop("_range", "_earlier", "_inner")
