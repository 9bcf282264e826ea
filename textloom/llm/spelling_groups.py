"""Records that differ only in formatting, collapsed by dictionary encoding.

Each distinct value of a column is canonicalised once and given an integer.
Records become sorted tuples of (field, value) integers, and the compact
tuples are grouped: one row per group with its first record and its number of
copies, or one row per later copy.

Defined results: null or blank values make a record no case, as do values
without any letter or digit; repeated ids count once; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import batched, materialize

PARTS = regex.compile(r"[,;/]")
# Variation selectors and the grapheme joiner are marks that nobody sees.
DROPPED = regex.compile(r"[^\p{L}\p{M}\p{N}]+|[︀-️͏\U000E0100-\U000E01EF]+")


def canonical(value: str | None) -> str | None:
    """Letters with their marks and digits, case folded and composed; parts between , ; / sorted."""
    if value is None:
        return None
    folded = unicodedata.normalize("NFC", unicodedata.normalize("NFC", value).casefold())
    parts = (unicodedata.normalize("NFC", DROPPED.sub("", x)) for x in PARTS.split(folded))
    return "\x1f".join(sorted(x for x in parts if x)) or None


def value_dictionary(values: DataFrame) -> DataFrame:
    """(value, code bigint) of the distinct values of a one-column table.

    Values that are the same label share a code. Distinct values are found
    with a map-side combine, so a value that fills a third of the rows costs a
    row per task; codes are numbered without a global sort.
    """
    distinct = values.toDF("value").where("value is not null").distinct().select("value", batched(canonical, "string")("value").alias("canon")).where("canon is not null")
    distinct = materialize(distinct, "canon")
    codes = distinct.select("canon").distinct().select("canon", F.monotonically_increasing_id().alias("code"))
    codes = materialize(codes, "codes")
    return materialize(distinct.join(codes, "canon").select("value", "code"), "dictionary")


def group_copies(records: DataFrame, keys: list[Column | str], record_id: str) -> tuple[DataFrame, DataFrame]:
    """(groups with first_id and n_copies, records with their keys); groups are pre-aggregated on the map side."""
    named = records.select(F.col(record_id).alias("rec_id"), *(F.col(k).alias(f"k{i}") if isinstance(k, str) else k.alias(f"k{i}") for i, k in enumerate(keys)))
    cols = [c for c in named.columns if c != "rec_id"]
    groups = named.groupBy(*cols).agg(F.min("rec_id").alias("first_id"), F.count("*").alias("n_copies"))
    return groups, named


def later_copies(records: DataFrame, keys: list[Column | str], record_id: str) -> DataFrame:
    """(first_id, copy_id) for each record that has an earlier one with equal keys.

    Only groups of two and more come back to the records; the join is a plain
    equi-join, which the adaptive skew rule splits on the record side when one
    group holds a large part of the rows.
    """
    groups, named = group_copies(records, keys, record_id)
    cols = [c for c in named.columns if c != "rec_id"]
    many = groups.where("n_copies > 1").select(*(F.col(c).alias(f"g_{c}") for c in cols), "first_id")
    on = [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in cols]
    return named.join(many, on).where("rec_id > first_id").select("first_id", F.col("rec_id").alias("copy_id")).distinct()


def encoded_nodes(nodes: DataFrame) -> DataFrame:
    """(rec_id, graph_id, label code)."""
    rows = nodes.select(F.col("node_id").alias("rec_id"), "graph_id", F.col("label").alias("value"))
    codes = value_dictionary(rows.select("value"))
    return materialize(rows.join(codes, "value").select("rec_id", "graph_id", "code"), "coded-nodes")


def encoded_triplets(triplets: DataFrame) -> DataFrame:
    """(rec_id, graph_id, relation code, lower code, upper code); relations have codes as they are written, subject and object may change places."""
    rows = triplets.select(F.col("triplet_id").alias("rec_id"), "graph_id", "subject", "relation", "object")
    rows = rows.where("subject is not null and object is not null")
    codes = value_dictionary(rows.select(F.explode(F.array("subject", "object"))))
    coded = rows.join(codes.select(F.col("value").alias("subject"), F.col("code").alias("s")), "subject")
    coded = coded.join(codes.select(F.col("value").alias("object"), F.col("code").alias("o")), "object")
    relations = materialize(rows.select("relation").where("relation is not null").distinct().select("relation", F.monotonically_increasing_id().alias("r")), "relations")
    coded = coded.join(relations, "relation", "left")
    pairs = coded.select("rec_id", "graph_id", "r", F.least("s", "o").alias("lo"), F.greatest("s", "o").alias("hi"))
    return materialize(pairs, "coded-triplets")  # read twice: to group, and to find the copies


def found(nodes: DataFrame, triplets: DataFrame) -> DataFrame:
    """(src, first_id, copy_id) over node labels and triplets of the same graph."""
    a = later_copies(encoded_nodes(nodes), ["graph_id", "code"], "rec_id")
    b = later_copies(encoded_triplets(triplets), ["graph_id", "r", "lo", "hi"], "rec_id")
    return a.select(F.lit("node").alias("src"), "first_id", "copy_id").unionByName(b.select(F.lit("triplet").alias("src"), "first_id", "copy_id"))


def collapsed(nodes: DataFrame, triplets: DataFrame) -> DataFrame:
    """(src, graph_id, first_id, n_copies): one row for each distinct label or triplet of a graph."""
    a, _ = group_copies(encoded_nodes(nodes), ["graph_id", "code"], "rec_id")
    b, _ = group_copies(encoded_triplets(triplets), ["graph_id", "r", "lo", "hi"], "rec_id")
    pick = lambda df, src: df.select(F.lit(src).alias("src"), F.col("k0").alias("graph_id"), "first_id", "n_copies")
    return pick(a, "node").unionByName(pick(b, "triplet"))
