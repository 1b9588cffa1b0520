"""Ranges of numbers in slices chosen by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: how many numbers a slice of the sampling job holds.
PER_SLICE = 100_000


def number_range(spark: SparkSession, n: int | None = None, partitions: int = 2) -> DataFrame:
    """The numbers 1 .. n, by default ``PER_SLICE`` for each partition."""
    last = PER_SLICE * partitions if n is None else n
    return spark.range(1, last + 1, 1, partitions)


def range_slices(spark: SparkSession, n: int = 1000, slices: int = 100) -> DataFrame:
    """The numbers 0 .. n-1 in ``slices`` partitions."""
    return spark.range(0, n, 1, slices)
