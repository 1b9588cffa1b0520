"""Scan of job listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.operators.records import latest_records
from jobledger.schemas import JOB_RECORD, LISTING


#: What says which record of an id is the last one.
ARRIVAL = ("arrival", "listing_pos")


def job_listing(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    arrival: str | None = None,
    stream: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The records of stored listing replies, with when they came and ``listing_pos``.

    ``arrival`` names a number in each reply, such as a snapshot id, that says when it was taken;
    without it the time of the file counts. ``listing_pos`` is a record's place in its listing. Keys
    outside the schema are ignored. Unless ``multi_line``, files hold one reply per line and split.
    ``stream`` gives the same rows as a stream of the files that come to ``path``.
    """
    schema = LISTING if arrival is None else T.StructType([*LISTING.fields, T.StructField(arrival, T.LongType())])
    reader = spark.readStream if stream else spark.read
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    replies = reader.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    came = F.col("_metadata.file_modification_time") if arrival is None else F.col(arrival)
    placed = replies.select("from", came.alias("arrival"), F.posexplode("sessions").alias("_pos", "_job"))
    return placed.select("_job.*", "arrival", (F.col("from") + F.col("_pos")).alias("listing_pos"))


def job_records(
    spark: SparkSession, path: str, multi_line: bool = False, arrival: str | None = None
) -> DataFrame:
    """One record per id: of the latest arrival, and within it the last in listing order."""
    return latest_records(job_listing(spark, path, multi_line, arrival), ARRIVAL)


def record_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Records stored one per row, in the fixed schema, as ``json`` or ``parquet``."""
    return spark.read.schema(JOB_RECORD).format(fmt).load(path)
