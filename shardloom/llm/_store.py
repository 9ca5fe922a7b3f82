"""Shared scratch tables: lineage is cut by writing Parquet where every executor can read it."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; where that is unset and all tasks run in this process (tests), below a local one.

    Raises RuntimeError on a cluster that names no shared folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/shardloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so later stages don't recompute it."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose rows are no longer needed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now: its cleaner waits for the driver's garbage collection, every 30 minutes."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 512, size: int = 1_000_000) -> None:
    """Bound the rows and bytes that one Arrow batch hands to a Python worker.

    The bound is the session's and stays; every operator sets the same one, so that none alters the plans of another.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def freeze(*columns: np.ndarray) -> bytes:
    """Columns of equal length as one compressed blob."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def thaw(blob: bytes, *types: str) -> list[np.ndarray]:
    """The columns of a blob, of these types."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return out
