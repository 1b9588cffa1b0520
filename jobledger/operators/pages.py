"""Pages of records in key order, one at a time or from an index that is written once.

Rows are in the order of their key and, where that is equal, of a hash of 128 bits of all their
columns, so the order is total but for rows that are equal in full, and these cannot be told apart.
Rows are counted by (key, hash) first, dealt into ranges by that order and written, a file
a range. A page reads the ranges that it needs, by a filter that reaches the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.plans.session import fresh_dir

#: Rows of a page up to which its keys are broadcast; equal rows are written out so many at a time;
#: ranges of a page up to which what is before them is part of the plan.
SMALL, CHUNK, FEW = 10_000, 4096, 100


def _whole(value: Column, kind: T.DataType) -> Column:
    """A value whose hash tells any two of ``kind`` apart: hashes pass over nulls and cannot take maps."""
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        entries = F.transform(F.map_entries(value), lambda x: _whole(x, entry))
        return F.struct(value.isNull(), F.size(value), F.array_sort(entries))
    if isinstance(kind, T.ArrayType):
        return F.struct(value.isNull(), F.size(value), F.transform(value, lambda x: _whole(x, kind.elementType)))
    if isinstance(kind, T.StructType):
        return F.struct(value.isNull(), *[_whole(value[field.name], field.dataType) for field in kind])
    return F.struct(value.isNull(), value)


def row_hash(rows: DataFrame) -> Column:
    """128 bits of all columns."""
    columns = [_whole(F.col(f"`{field.name}`"), field.dataType) for field in rows.schema]
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


@dataclass(frozen=True)
class PageIndex:
    """Rows dealt into ranges below ``path``, with the number of rows before each range."""

    spark: SparkSession
    path: str
    schema: T.StructType
    #: (range, rows before it, rows in it), one for each partition that the rows were sorted in.
    slabs: tuple[tuple[int, int, int], ...]

    @staticmethod
    def write(records: DataFrame, path: str | None = None, key: str = "id", narrow: bool = False) -> PageIndex:
        """Index ``records`` by ``key``, of any type that sorts, once for a snapshot.

        ``path`` is new, by default a folder in the shared one. ``narrow`` leaves the records out:
        pages then have their keys and hashes.
        """
        spark = records.sparkSession
        path = path or fresh_dir(spark, "page")
        rows = records.select(
            F.col(key).alias("_key"), row_hash(records).alias("_hash"), F.struct(*records.columns).alias("_row")
        )
        kept = [] if narrow else [F.first("_row").alias("_row")]
        spots = rows.groupBy("_key", "_hash").agg(F.count(F.lit(1)).alias("_n"), *kept)
        order = ["_key", "_hash.a", "_hash.b"]
        dealt = spots.repartitionByRange(*order).sortWithinPartitions(*order)
        dealt = dealt.withColumn("_slab", F.spark_partition_id())
        dealt.write.parquet(f"{path}/rows")
        counts = spark.read.schema("_slab int, _n bigint").parquet(f"{path}/rows")
        counts = counts.groupBy("_slab").agg(F.sum("_n").alias("n"))
        if narrow:
            return PageIndex._of(spark, path, dealt.schema, counts)
        counts.coalesce(1).write.parquet(f"{path}/slabs")
        return PageIndex.open(spark, path)

    @staticmethod
    def open(spark: SparkSession, path: str) -> PageIndex:
        """The index that ``write`` left below ``path``. Its ranges, a row for each, come to the driver."""
        schema = spark.read.parquet(f"{path}/rows").schema
        return PageIndex._of(spark, path, schema, spark.read.schema("_slab int, n bigint").parquet(f"{path}/slabs"))

    @staticmethod
    def _of(spark: SparkSession, path: str, schema: T.StructType, counts: DataFrame) -> PageIndex:
        before, slabs = 0, []
        for slab, n in sorted(map(tuple, counts.collect())):
            slabs.append((slab, before, n))
            before += n
        return PageIndex(spark, path, schema, tuple(slabs))

    @property
    def total(self) -> int:
        return sum(n for _, _, n in self.slabs)

    def _spots(self, start: int, size: int | None) -> DataFrame:
        """The (key, hash) groups on a page with the first rank of each; only its ranges are read."""
        end = self.total if size is None else min(start + size, self.total)
        needed = [(slab, before) for slab, before, n in self.slabs if before < end and before + n > start]
        found = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        if len(needed) < len(self.slabs):
            low, high = (needed[0][0], needed[-1][0]) if needed else (0, -1)
            found = found.where(F.col("_slab").between(low, high))
        within = Window.partitionBy("_slab").orderBy("_key", "_hash")
        if len(needed) <= FEW:
            offset = F.coalesce(*[F.when(F.col("_slab") == slab, F.lit(before)) for slab, before in needed], F.lit(0))
            found = found.withColumn("_before", offset.cast("bigint"))
        else:
            ranges = self.spark.createDataFrame(needed, "_slab int, _before bigint")  # a row a range
            found = found.join(F.broadcast(ranges), "_slab")
        found = found.withColumn("_first", F.col("_before") + F.sum("_n").over(within) - F.col("_n"))
        return found.where((F.col("_first") < end) & (F.col("_first") + F.col("_n") > start))

    def _ranked(self, rows: DataFrame, start: int, size: int | None) -> DataFrame:
        """A row (``_row``, ``rank``) for every rank on the page, from one row a group."""
        end = self.total if size is None else start + size
        low = F.greatest(F.col("_first"), F.lit(start))
        high = F.least(F.col("_first") + F.col("_n"), F.lit(end)) - 1
        chunks = F.explode(F.sequence(low, high, F.lit(CHUNK).cast("bigint"))).alias("_low")
        rows = rows.select("_row", high.alias("_high"), chunks)
        each = F.explode(F.sequence("_low", F.least(F.col("_low") + CHUNK - 1, "_high"))).alias("rank")
        return rows.select("_row", each).select(
            "_row.*", "rank", F.lit(start).cast("bigint").alias("from"), F.lit(self.total).cast("bigint").alias("total")
        )

    def page(self, start: int | None = None, size: int | None = None) -> DataFrame:
        """As ``page``, of the records that the index holds."""
        start, size = start or 0, size or None
        return self._ranked(self._spots(start, size), start, size)


def page(
    records: DataFrame, start: int | None = None, size: int | None = None, key: str = "id"
) -> DataFrame:
    """The rows ``start`` .. ``start+size`` in key order, with columns ``rank``, ``from``, ``total``.

    ``rank`` counts from 0 in ascending order of the key, a missing key first; sort by it to see the
    page in order. Pages of any sizes have every row once, however the input is dealt, ties too. 0
    and ``None`` both mean the default: from the first row, all rows.

    Only keys and hashes are sorted and written; the records are then joined to those of the page.
    For more than one page of a snapshot write a ``PageIndex`` of it.
    """
    start, size = start or 0, size or None
    index = PageIndex.write(records, key=key, narrow=True)
    spots = index._spots(start, size).select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"), "_first", "_n")
    if size is not None and size <= SMALL:
        spots = F.broadcast(spots)
    rows = records.select(
        F.col(key).alias("_key"), row_hash(records).alias("_hash"), F.struct(*records.columns).alias("_row")
    )
    found = rows.join(spots, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")))
    # Equal rows are one row here, and are counted out again.
    found = found.groupBy("_first", "_n").agg(F.first("_row").alias("_row"))
    return index._ranked(found, start, size)
