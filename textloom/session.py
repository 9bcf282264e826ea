"""Session helpers: table access, shared scratch folders, code shipping."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share, named by spark.checkpoint.dir.

    Only when the session names none (tests, single-machine use) a folder of
    this machine is chosen and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder for a table that cuts lineage."""
    return f"{checkpoint_root(spark)}/{what}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, what: str, parts: list[str] | None = None, group_bytes: int = 128 << 20) -> DataFrame:
    """Write df to the shared folder and read it back: computed once, safe against lost executors."""
    path = shared_dir(df.sparkSession, what)
    df.write.option("parquet.block.size", group_bytes).partitionBy(*(parts or [])).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the files of a table that materialize() wrote and nothing reads any more."""
    path = getattr(df, "_written_at", None)
    if path:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def qualified(df: DataFrame) -> str:
    """The whole URI of a table that materialize() wrote, for readers outside Spark."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString()


def batched(fn: Callable, kind: str) -> Callable[..., Column]:
    """A Spark function that applies fn to each value of a column, in Arrow batches."""

    @F.pandas_udf(kind)
    def apply(values: pd.Series) -> pd.Series:
        return pd.Series([fn(v) for v in values], dtype=object)

    return apply


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_textloom_shipped", False):
        return
    root = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="spark-")) / "textloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._textloom_shipped = True
