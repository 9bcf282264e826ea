"""Vectors of clusters: centroids, representatives, similarity of given queries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def centroids(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, place, value): mean vectors in long form; means combine on the map side."""
    long = rows.select(key, F.posexplode(vector).alias("place", "x"))
    return long.groupBy(key, "place").agg(F.avg(F.col("x").cast("double")).alias("value"))


def representatives(rows: DataFrame, key: str, item: str, vector: str) -> DataFrame:
    """(key, item, similarity, size): the member nearest to its group's mean by cosine, the smaller item among equals."""
    means = centroids(rows, key, vector).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda s: s["value"]).alias("mean"))
    joined = rows.select(key, item, F.col(vector).alias("v")).join(means, key)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    dot = total(F.zip_with("v", "mean", lambda a, b: a.cast("double") * b))
    length = F.sqrt(total(F.transform("v", lambda a: a.cast("double") * a.cast("double")))) * F.sqrt(total(F.transform("mean", lambda a: a * a)))
    scored = joined.select(key, item, F.round(F.try_divide(dot, length), 6).alias("similarity"))
    best = scored.groupBy(key).agg(F.max(F.struct("similarity", (-F.col(item)).alias("minus"))).alias("b"), F.count("*").alias("size"))
    return best.select(key, (-F.col("b.minus")).alias(item), F.col("b.similarity").alias("similarity"), "size")


def nearest_by_label(queries: DataFrame, rows: DataFrame, item: str, label: str, vector: str, block: int = 1024) -> DataFrame:
    """(query, label, best, nearest): for each query the best cosine within each label and the smallest item that has it; queries are a stated set against all rows.

    Queries are cut into blocks; each block meets each batch of rows as one
    matrix product, and only the best of each (query, label) leaves the batch.
    """
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    unit = lambda df: df.where(total(F.transform(vector, lambda a: a.cast("double") * a.cast("double"))) > 0)
    q = unit(queries.select(item, vector)).withColumn("_block", F.floor(F.pmod(F.xxhash64(item), F.lit(1 << 30)) / (1 << 30) * F.lit(max(1, -(-queries.count() // block)))))
    blocks = q.groupBy("_block").agg(F.collect_list(item).alias("ids"), F.collect_list(vector).alias("vs"))  # about `block` queries
    r = unit(rows.select(item, label, vector)).withColumn("_part", F.pmod(F.xxhash64(item), F.lit(max(1, rows.sparkSession.sparkContext.defaultParallelism))))
    parts = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(max(1, rows.sparkSession.sparkContext.defaultParallelism)) - 1)).alias("_part")).withColumn("_part", F.col("_part").cast("bigint"))
    kind = rows.schema[label].dataType.simpleString()

    def best(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        names, values, ids = right[label].to_numpy(), scaled(right[vector]), right[item].to_numpy()
        for own, vs in zip(left["ids"], left["vs"], strict=True):
            own = np.asarray(own)
            if not len(ids):
                continue
            sim = np.round(scaled(vs) @ values.T, 6)
            sim[own[:, None] == ids[None, :]] = -np.inf
            for name in pd.unique(names):
                at = np.flatnonzero(names == name)
                top = sim[:, at].max(axis=1)
                first = np.where(sim[:, at] == top[:, None], ids[at][None, :], np.iinfo(np.int64).max).min(axis=1)
                out += [(o, name, s, f) for o, s, f in zip(own, top, first, strict=True) if np.isfinite(s)]
        return pd.DataFrame(out, columns=["query", label, "best", "nearest"])

    met = parts.groupBy("_part").cogroup(r.groupBy("_part")).applyInPandas(best, f"query bigint, {label} {kind}, best double, nearest bigint")
    return met.groupBy("query", label).agg(F.max(F.struct("best", (-F.col("nearest")).alias("minus"))).alias("b")).select("query", label, F.col("b.best").alias("best"), (-F.col("b.minus")).alias("nearest"))


def scaled(vectors: object) -> np.ndarray:
    """Vectors as rows of length 1 in double precision."""
    v = np.array([np.asarray(x, float) for x in vectors])
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def extremes(best: DataFrame, value: str, keys: list[str], n: int) -> DataFrame:
    """(keys, value, end): the n best and the n worst alignments."""
    top = best.orderBy(F.desc(value), *keys).limit(n).withColumn("end", F.lit("best"))
    return top.unionByName(best.orderBy(F.asc(value), *keys).limit(n).withColumn("end", F.lit("worst")))


def pooled(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, place, value): the mean of a key's distinct vectors, scaled to length 1, in long form."""
    means = centroids(rows.select(key, vector).distinct(), key, vector)
    sizes = means.groupBy(key).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("_size"))
    return means.join(sizes, key).select(key, "place", (F.col("value") / F.when(F.col("_size") > 0, F.col("_size")).otherwise(1.0)).alias("value"))


def kmeans(rows: DataFrame, item: str, vector: str, k: int | None = None, seed: int = 42) -> DataFrame:
    """(item, cluster): k-means; without k there are max(2, √(n/2)) clusters, never more than rows."""
    points = rows.select(item, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    n = points.count()
    if n < 2:
        return points.select(item, F.lit(0).alias("cluster"))
    model = KMeans(k=min(n, k or max(2, int((n / 2) ** 0.5))), seed=seed, maxIter=20).fit(points)
    return model.transform(points).select(item, F.col("prediction").alias("cluster"))


def side_metrics(best: DataFrame) -> DataFrame:
    """(precision, recall, f1) from best similarities of two sides (side 'generated' or 'reference', best)."""
    mean = lambda s: F.coalesce(F.avg(F.when(F.col("side") == s, F.col("best"))), F.lit(0.0))
    rows = best.agg(mean("generated").alias("precision"), mean("reference").alias("recall"))
    both = F.col("precision") + F.col("recall")
    return rows.select(F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round(F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0), 6).alias("f1"))


def ranked_in(rows: DataFrame, key: str, order: list, n: int) -> DataFrame:
    """The first n rows of each key in a total order."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("place") <= n)
