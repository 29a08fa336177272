"""Cutting lineage in the folder that the cluster shares, and broadcasts of a checked size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few columns that may be broadcast.
FEW = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only in local mode, where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named or sc.getCheckpointDir():
        return named or sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder."""
    sc, folder = df.sparkSession.sparkContext, shared_dir(df.sparkSession)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The table written to the shared folder as compressed columns, in one pass over it, and read back from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_size(df: DataFrame, most: int = FEW) -> Callable[[DataFrame], DataFrame]:
    """A broadcast hint for tables no larger than this one, if it has at most `most` rows; else no hint."""
    return F.broadcast if df.limit(most + 1).count() <= most else lambda side: side


def narrow(df: DataFrame) -> DataFrame:
    """The table with a broadcast hint if it is as small as `by_size` asks."""
    return by_size(df)(df)
