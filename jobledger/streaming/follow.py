"""Follow jobs in a stream of polls (batch_id, poll_seq, state, lines, ...).

What a micro-batch has to know of the ones before is in the engine's state store: where each job
ended, one row a job (``job_ends``), and where each line of a job first stood (``first_places``).
Micro-batches touch the keys they hold and read no earlier output. The state is read with Spark's
reader for it.

A terminal poll may arrive after polls that it should have cut off, and a line for a second time
from an earlier poll. The forms that drain a stream answer as the batch forms do over all polls,
however these were cut into files and in whatever order they came. The streaming forms beside them
give rows as they become known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.operators.records import is_active
from jobledger.plans.skew import lookup_join
from jobledger.streaming.jobs import END, JobEnds, JobWatch
from jobledger.streaming.sinks import drain, sink_rows, state_rows


def job_ends(polls: DataFrame, job: str = "batch_id", order: str = "poll_seq", state: str = "state") -> DataFrame:
    """A stream of (job, end): the order of the first terminal poll of a job, and again if an earlier
    one arrives. Polls without a job never end.

    Only (job, order, state) of terminal polls reaches the keyed state, one row a job that is over.
    """
    over = polls.where(F.col(job).isNotNull() & ~is_active(state)).select(job, order, state)
    schema = T.StructType([polls.schema[job], T.StructField(END, polls.schema[order].dataType)])
    processor = JobEnds(job, order, state, polls.schema[order].dataType)
    return over.groupBy(job).transformWithState(processor, schema, "Append", "None")


def _ends(polls: DataFrame, folder: str, job: str, order: str, state: str) -> DataFrame:
    """(job, _end) of all input there is now."""
    drain(job_ends(polls, job, order, state), f"{folder}/ends")
    schema = T.StructType([polls.schema[job], T.StructField("_end", polls.schema[order].dataType)])
    return state_rows(polls.sparkSession, f"{folder}/ends", schema, END)


def _until(rows: DataFrame, ends: DataFrame, job: str, order: str, spread_by: list[str], hot_keys: int | None) -> DataFrame:
    joined = lookup_join(rows, ends, job, spread_by, "left", hot_keys)
    return joined.where(F.col("_end").isNull() | (F.col(order) <= F.col("_end"))).drop("_end")


def follow_until_terminal(
    polls: DataFrame,
    folder: str,
    job: str = "batch_id",
    order: str = "poll_seq",
    state: str = "state",
    hot_keys: int | None = None,
) -> DataFrame:
    """The polls up to and including the first terminal one of their job, of all input there is now.

    A later call with the same folder goes on where this one stopped. The polls pass through the
    engine's file sink as they are and are cut by the state of ``job_ends`` when they are read, so
    the table equals ``logs.until_terminal`` of all polls.
    """
    ends = _ends(polls, folder, job, order, state)
    drain(polls, f"{folder}/polls", table=True)
    kept = sink_rows(polls.sparkSession, f"{folder}/polls", polls.schema)
    return _until(kept, ends, job, order, [order], hot_keys)


def first_places(
    polls: DataFrame, job: str = "batch_id", order: str = "poll_seq", lines: str = "lines"
) -> DataFrame:
    """A stream (job, line, place), to be written in update mode: every line of a job with the first
    place (order, pos) it was seen at, again whenever a micro-batch has it.

    Equal lines of a task are one row before the shuffle, so a line that fills a log stays small.
    """
    exploded = polls.select(job, order, F.posexplode_outer(lines).alias("pos", "line")).where("pos IS NOT NULL")
    return exploded.groupBy(job, "line").agg(F.min(F.struct(order, "pos")).alias("place"))


def new_lines(
    polls: DataFrame,
    job: str = "batch_id",
    order: str = "poll_seq",
    lines: str = "lines",
    at: str | None = None,
    horizon: str | None = None,
) -> DataFrame:
    """A stream (job, order, pos, line) that gives every line of a job when it first arrives.

    The lines of a job that were seen are kept for good. With ``horizon``, a time such as
    ``"2 hours"``, they are dropped so long after their time ``at``, which bounds the state of a stream
    that does not end: a line that comes back after the horizon comes out again, and polls that are
    later than it are left out. Times without a zone count as UTC in a session of that zone.
    """
    columns = [job, order] if at is None else [job, order, at]
    exploded = polls.select(*columns, F.posexplode_outer(lines).alias("pos", "line")).where("pos IS NOT NULL")
    if horizon is None:
        found = exploded.dropDuplicates([job, "line"])
    else:
        if at is None:
            raise ValueError("a horizon needs the name of a time in at")
        # A watermark takes no time without a zone.
        timed = exploded.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, horizon)
        found = timed.dropDuplicatesWithinWatermark([job, "line"])
    return found.select(job, order, "pos", "line")


def follow_stream(
    polls: DataFrame,
    folder: str,
    job: str = "batch_id",
    order: str = "poll_seq",
    state: str = "state",
    lines: str = "lines",
    hot_keys: int | None = None,
) -> DataFrame:
    """(job, order, pos, line): every line of a job once, where it first stood, until the job is over.

    Of all input there is now; sort by (job, order, pos) to read the logs. A later call with the same
    folder goes on where this one stopped. The table equals ``logs.first_seen_lines`` over
    ``logs.until_terminal`` of all polls: a line whose first place is after the end of its job has
    none before it. See ``new_lines`` for lines as they come.
    """
    ends = _ends(polls, folder, job, order, state)
    drain(first_places(polls, job, order, lines), f"{folder}/lines", mode="update")
    place = T.StructType([polls.schema[order], T.StructField("pos", T.IntegerType())])
    schema = T.StructType(
        [polls.schema[job], T.StructField("line", T.StringType()), T.StructField("_place", place)]
    )
    seen = state_rows(polls.sparkSession, f"{folder}/lines", schema)
    seen = seen.select(job, F.col("_place")[order].alias(order), F.col("_place.pos").alias("pos"), "line")
    return _until(seen, ends, job, order, [order, "pos"], hot_keys)


def watched(
    polls: DataFrame,
    timeout: float = 60,
    job: str = "batch_id",
    order: str = "poll_seq",
    state: str = "state",
    at: str = "ts",
    forget: float | None = None,
) -> DataFrame:
    """A stream (job, waited in microseconds, silent) of jobs that are active for over ``timeout``
    seconds, or silent for as long; see ``JobWatch``. Only (job, order, state, at) reaches the state.
    """
    narrow = polls.where(F.col(job).isNotNull()).select(job, order, state, at)
    schema = T.StructType(
        [polls.schema[job], T.StructField("waited", T.LongType()), T.StructField("silent", T.BooleanType())]
    )
    processor = JobWatch(job, order, state, at, polls.schema[order].dataType, timeout, forget)
    return narrow.groupBy(job).transformWithState(processor, schema, "Append", "ProcessingTime")


def stuck_jobs(
    polls: DataFrame,
    folder: str,
    timeout: float = 60,
    job: str = "batch_id",
    order: str = "poll_seq",
    state: str = "state",
    at: str = "ts",
    forget: float | None = None,
) -> DataFrame:
    """(job, waited, silent) of jobs that were active for more than ``timeout`` seconds after their
    first poll, of all input there is now; ``waited`` in seconds.

    A job counts as active up to its last active poll. One whose polls stopped is told of with
    ``silent`` by a call that comes the timeout after, and by a query on ``watched`` that goes on
    as soon as that has passed. Equals ``logs.poll_outcome`` over ``logs.until_terminal`` where each
    job's polls come in order, in any order within a micro-batch; a terminal poll that arrives in a
    later micro-batch than polls after it does not take back what these have shown. Polls without a
    job are not watched.
    """
    drain(watched(polls, timeout, job, order, state, at, forget), folder, table=True, timers=True)
    schema = T.StructType(
        [polls.schema[job], T.StructField("waited", T.LongType()), T.StructField("silent", T.BooleanType())]
    )
    told = sink_rows(polls.sparkSession, folder, schema)
    waited = (F.max("waited").cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return told.groupBy(job, "silent").agg(waited.alias("waited")).select(job, "waited", "silent")
