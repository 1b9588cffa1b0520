"""Run a stream over the data that is there now, and read what its state and its sink hold."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for queries that start meanwhile, which take a copy; the session keeps its own."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start(
    stream: DataFrame, folder: str, table: bool = False, mode: str = "append", idle: bool = True, **trigger
) -> StreamingQuery:
    """Start a query whose checkpoint is in ``folder``, with its state in RocksDB.

    ``table`` writes its rows to ``{folder}/table`` by the engine's file sink, which takes a
    micro-batch once however often it is tried; otherwise only the state counts. ``idle`` lets
    micro-batches run without new input, which timers of keyed state need to go off. ``trigger`` is
    that of the writer.
    """
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").outputMode(mode)
    writer = writer.format("parquet").option("path", f"{folder}/table") if table else writer.format("noop")
    with _settings(stream.sparkSession, {_PROVIDER: _ROCKSDB, _IDLE: str(idle).lower()}):
        return writer.trigger(**trigger).start()


def drain(
    stream: DataFrame, folder: str, table: bool = False, mode: str = "append", timers: bool = False
) -> list[dict]:
    """Run over all input there is now; with the folder of an earlier run, from where that stopped.

    ``timers`` lets those of keyed state go off that are due by then. Returns the progress of the
    micro-batches with input.
    """
    query = start(stream, folder, table, mode, idle=False, availableNow=True)
    try:
        query.awaitTermination()
        done = query.recentProgress
    finally:
        query.stop()
    if timers:
        # A query with timers goes on without input for ever; one such micro-batch is enough.
        query = start(stream, folder, table, mode, availableNow=True)
        try:
            while not query.awaitTermination(1):
                if query.recentProgress:
                    break
        finally:
            query.stop()
    return done


def state_rows(spark: SparkSession, folder: str, schema: T.StructType, variable: str | None = None) -> DataFrame:
    """What the state of the query in ``folder`` holds: the columns of its keys and its values.

    ``schema`` is theirs, for a query that has had no input yet.
    """
    reader = spark.read.format("statestore")
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    try:
        found = reader.load(f"{folder}/checkpoint")
    except PySparkException as error:
        if error.getCondition() not in _NO_STATE:
            raise
        return spark.createDataFrame([], schema)
    return found.select("key.*", "value.*").toDF(*schema.names)


def sink_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows that the query in ``folder`` has written so far."""
    try:
        return spark.read.schema(schema).parquet(f"{folder}/table")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


#: What the state reader says where no micro-batch has run.
_NO_STATE = (
    "STDS_COMMITTED_BATCH_UNAVAILABLE",
    "STDS_NO_PARTITION_DISCOVERED_IN_STATE_STORE",
    "STDS_OFFSET_METADATA_LOG_UNAVAILABLE",
)
