"""The latest record of every id, kept up to date from a stream of listings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.operators.records import latest_records
from jobledger.sources.records import ARRIVAL


#: Rows that a task puts in place of a directory's, about; a directory of more is written by several.
TASK_ROWS = 200_000


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest_table(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The table that ``keep_latest`` keeps in ``folder``."""
    return _read(spark, f"{folder}/table", T.StructType([*schema.fields, _BUCKET])).drop(_BUCKET.name)


def keep_latest(
    folder: str, buckets: int, key: str = "id", arrival: Sequence[str] = ARRIVAL
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that merges records into the table in ``folder``.

    The table has a directory for each of ``buckets`` hashes of the key; a micro-batch reads and
    writes those that its keys fall into, and no other. A record of a later ``arrival`` replaces one
    that came before, in whatever order the listings are read, as in ``latest_records``. What is to
    be written is stored first and then put in place of its directories, so a micro-batch that is
    tried again after a failure finds it and does that once more. Tasks write ranges of (bucket, key),
    so that however few the buckets, no task has one whole that is large.
    """

    def merge(records: DataFrame, epoch: int) -> None:
        spark = records.sparkSession
        schema = T.StructType([*records.schema.fields, _BUCKET])
        ready, staged = f"{folder}/ready/epoch={epoch}", f"{folder}/staged"
        if not _read(spark, ready, T.StructType([T.StructField("id", T.LongType())])).head(1):
            bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
            new = latest_records(records, arrival, key).withColumn(_BUCKET.name, bucket).persist()
            touched = [row[0] for row in new.select(_BUCKET.name).distinct().collect()]  # a number a bucket
            old = _read(spark, f"{folder}/table", schema).where(F.col(_BUCKET.name).isin(touched))
            latest_records(old.unionByName(new), arrival, key).write.mode("overwrite").parquet(staged)
            new.unpersist()
            spark.range(1).write.mode("overwrite").parquet(ready)
        merged = spark.read.schema(schema).parquet(staged)
        merged = merged.repartitionByRange(buckets + merged.count() // TASK_ROWS, _BUCKET.name, key)
        replaced = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replaced.partitionBy(_BUCKET.name).parquet(f"{folder}/table")

    return merge


def latest_listing(listings: DataFrame, folder: str, buckets: int, key: str = "id") -> DataFrame:
    """The latest record of every id in a stream of ``job_listing`` rows, of all input there is now.

    A later call with the same folder goes on where this one stopped. Equals ``latest_records`` over
    all listings. For a stream that does not end, give ``keep_latest`` to ``foreachBatch``.
    """
    query = (
        listings.writeStream.foreachBatch(keep_latest(folder, buckets, key))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return latest_table(listings.sparkSession, folder, listings.schema)


_BUCKET = T.StructField("_bucket", T.IntegerType())
