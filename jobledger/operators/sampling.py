"""Jobs that run on the workers: a sampling ratio, an inventory of the workers, counts per day."""

from __future__ import annotations

import importlib
import socket
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def uniform_points(rows: DataFrame, seed: int | None = None) -> DataFrame:
    """A point (x, y), uniform in [-1, 1), for every row."""
    other = None if seed is None else seed + 1
    return rows.select((F.rand(seed) * 2 - 1).alias("x"), (F.rand(other) * 2 - 1).alias("y"))


def mc_ratio(points: DataFrame) -> DataFrame:
    """(hits, n, ratio): points in the unit circle, all points, and 4 * hits / n."""
    hit = F.col("x") * F.col("x") + F.col("y") * F.col("y") <= 1
    counts = points.agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ratio", F.lit(4.0) * F.col("hits") / F.col("n"))


def worker_facts(rows: DataFrame, libraries: Sequence[str] = ("pandas",), together: bool = False) -> DataFrame:
    """(info, elements, slice): host, interpreter and library paths of the worker of each batch of
    rows, with the number of rows and the partition.

    All rows of a batch see the same worker, so one line per batch stands for its elements. A
    library that cannot be imported fails the job. ``together`` runs all partitions at once, by
    barrier execution, so that no worker takes the place of another; it needs as many free slots
    as there are partitions, and then a partition without rows is seen too, with 0 elements.
    """
    names = list(libraries)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths = [importlib.import_module(name).__file__ for name in names]
        info = ",".join([socket.gethostname(), sys.executable, *paths])
        context = BarrierTaskContext.get() if together else TaskContext.get()
        if together:
            context.barrier()  # every slot is taken before any is given back
            yield pd.DataFrame({"info": [info], "elements": [0], "slice": [context.partitionId()]})
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"info": [info], "elements": [len(batch)], "slice": [context.partitionId()]})

    return rows.mapInPandas(look, "info string, elements bigint, slice int", barrier=together)


def worker_inventory(
    rows: DataFrame, libraries: Sequence[str] = ("pandas",), slices: int | None = None, together: bool = False
) -> DataFrame:
    """(info, elements, slices): the distinct workers that ran over the rows, with what each has done.

    ``slices`` deals the rows to so many partitions. With ``together`` these run at once, so with as
    many slices as the cluster has slots every slot is seen, which plain tasks do not promise: a quick
    worker takes the tasks of others.
    """
    dealt = rows if slices is None else rows.repartition(slices)
    facts = worker_facts(dealt, libraries, together)
    return facts.groupBy("info").agg(
        F.sum("elements").alias("elements"), F.count_distinct("slice").cast("int").alias("slices")
    )


def daily_counts(rows: DataFrame, at: Column | str) -> DataFrame:
    """(day, n): rows per calendar day."""
    at = F.col(at) if isinstance(at, str) else at
    return rows.groupBy(F.to_date(at).alias("day")).agg(F.count(F.lit(1)).alias("n"))
