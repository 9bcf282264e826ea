"""Text folders, graph files and their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODE = "array<struct<id: string, label: string, members: array<string>, importance: double>>"
EDGE = "array<struct<id: string, source: string, target: string, label: string, weight: bigint, importance: double>>"
GRAPH = f"struct<nodes: {NODE}, edges: {EDGE}>"


def text_folder(spark: SparkSession, path: str, name: str = r"([^/]+)\.txt$") -> DataFrame:
    """(name, text) of each .txt file below a folder; the name is what the pattern takes from its path."""
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).text(path)
    return rows.select(F.regexp_extract(F.url_decode(F.input_file_name()), name, 1).alias("name"), F.col("value").alias("text"))


def folder_statistics(spark: SparkSession, path: str, now: str) -> DataFrame:
    """(folder, files, bytes, recent): counts of each folder; recent files changed in the 24 hours before now."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    recent = F.col("modificationTime") >= F.lit(now).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.count_if(recent).alias("recent"))


def graph_files(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(file, variant, nodes, edges): single graphs (variant null), variants and the older thresholds form in one shape; a file holds one graph, or one on each line."""
    schema = f"nodes {NODE}, edges {EDGE}, variants map<string, {GRAPH}>, thresholds map<string, {GRAPH}>"
    rows = spark.read.schema(schema).option("multiLine", not lines).json(path).withColumn("file", F.input_file_name())
    many = rows.select("file", F.explode(F.coalesce("variants", "thresholds")).alias("variant", "g")).select("file", "variant", "g.nodes", "g.edges")
    one = rows.where("variants is null and thresholds is null").select("file", F.lit(None).cast("string").alias("variant"), "nodes", "edges")
    return one.unionByName(many)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line; letters beyond ASCII are kept as they are."""
    df.write.mode("overwrite").json(path)
