"""Bounds on the Arrow batches that Python workers get, for the time of one action."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """At most ``rows`` rows and some ``size`` bytes a batch while the block runs; the session's own settings hold again behind it."""
    before = [spark.conf.get(s) for s in SETTINGS]
    for s, value in zip(SETTINGS, (rows, size), strict=True):
        spark.conf.set(s, str(value))
    try:
        yield
    finally:
        for s, value in zip(SETTINGS, before, strict=True):
            spark.conf.set(s, value)
