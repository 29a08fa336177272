"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one only in local mode, where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder: later jobs reread these rows instead of computing them anew."""
    spark = df.sparkSession
    folder, sc = shared_dir(spark), spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def texts(batch, name: str = "text") -> list[str]:
    """A text column of an Arrow batch, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


class Cover:
    """What spans of a text cover; tells in logarithmic time whether another span overlaps it."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.ends[i - 1] > start


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = 2000):
    """The same work on slices of at most `rows` rows; at its end the worker, which Spark keeps, hands its free memory back."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                yield batch.slice(at, rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(sliced(batches))
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return work
