"""Semantic duplicates and entity classes over given candidate pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.graphs import components


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision; null if either has length 0."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    size = lambda v: F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    return F.try_divide(dot, size(a) * size(b))


TILE = 1000  # rows of a key that meet as one matrix


def pairs_within(rows: DataFrame, key: str, item: str, vector: str, least: float, tile: int = TILE) -> DataFrame:
    """(key, a, b, similarity), a < b: pairs of a key at or above `least`.

    Exact copies are joined through their smallest item, so a group of copies
    makes one row each instead of all pairs. The rows of a key are cut into
    tiles of about `tile` rows; each two tiles meet as one matrix product in a
    task of their own, and only pairs at or above `least` leave it.
    """
    lead = rows.groupBy(key, vector).agg(F.min(item).alias("lead"))
    copies = rows.join(lead, [key, vector]).where(F.col(item) != F.col("lead")).select(key, F.col("lead").alias("a"), F.col(item).alias("b"), F.lit(1.0).alias("similarity"))
    tiles = lead.groupBy(key).agg(F.ceil(F.count("*") / tile).alias("_tiles"))
    cut = lead.join(tiles, key).withColumn("_own", F.pmod(F.xxhash64("lead"), F.col("_tiles"))).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_tiles") - 1)))
    met = cut.select(key, "lead", F.col(vector).cast("array<double>").alias("v"), "_own", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"))
    kind = {k: rows.schema[k].dataType.simpleString() for k in (key, item)}

    def similar(part: pd.DataFrame) -> pd.DataFrame:
        low, high = part["_low"].iloc[0], part["_high"].iloc[0]
        v = np.array([np.asarray(x, float) for x in part["v"]])
        size = np.sqrt((v * v).sum(axis=1))
        ids, own = part["lead"].to_numpy(), part["_own"].to_numpy()
        left, right = np.flatnonzero((own == low) & (size > 0)), np.flatnonzero((own == high) & (size > 0))
        sim = np.round((v[left] @ v[right].T) / np.outer(size[left], size[right]), 6)
        r, c = np.nonzero(sim >= least)
        x, y, s = ids[left[r]], ids[right[c]], sim[r, c]
        once = x < y if low == high else x != y
        return pd.DataFrame({key: part[key].iloc[0], "a": np.minimum(x, y)[once], "b": np.maximum(x, y)[once], "similarity": s[once]})

    near = met.groupBy(key, "_low", "_high").applyInPandas(similar, f"{key} {kind[key]}, a {kind[item]}, b {kind[item]}, similarity double")
    return near.unionByName(copies)


def entity_classes(names: DataFrame, pairs: DataFrame, item: str, name: str) -> DataFrame:
    """(item, class, representative): linked items form classes named by their shortest, then alphabetically first name."""
    linked = components(pairs, "a", "b").select(F.col("node").alias(item), F.col("component").alias("class"))
    rows = names.join(linked, item, "left").withColumn("class", F.coalesce("class", item))
    best = rows.groupBy("class").agg(F.min(F.struct(F.length(name).alias("n"), F.lower(name).alias("low"), F.col(name).alias("name"))).alias("b"))
    return rows.join(best, "class").select(item, "class", F.col("b.name").alias("representative"))


def first_spellings(rows: DataFrame, key: str, position: str, name: str) -> DataFrame:
    """(key, name): the first spelling of each name that differs by case and outer spaces only."""
    named = rows.where(F.trim(name) != "").select(key, position, name, F.lower(F.trim(name)).alias("low"))
    return named.groupBy(key, "low").agg(F.min_by(name, position).alias(name), F.min(position).alias(position)).drop("low")


def ranked_cap(rows: DataFrame, key: str, rank: Column, position: str, cap: int) -> DataFrame:
    """The first `cap` rows of each key by rank, then by position."""
    order = Window.partitionBy(key).orderBy(rank, position)
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= cap)
