"""Bringing a side to the driver or to every task only when its size has been checked."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession

BROADCAST_ROWS = 100_000


def rows_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> list[Row] | None:
    """The rows when there are at most ``limit`` of them, else None. Reads ``limit + 1`` at most."""
    rows = df.take(limit + 1)
    return rows if len(rows) <= limit else None


@contextmanager
def bounded_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs run inside send Arrow batches of about ``most`` bytes, or one row, to Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
