"""Operators on log polls: (batch_id, poll_seq, state, total, lines), one row per look at a job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobledger.functions.logs import log_contains
from jobledger.operators.records import is_active
from jobledger.plans.skew import with_key_minimum


def terminal_orders(
    polls: DataFrame, job: str = "batch_id", order: str = "poll_seq", state: str = "state"
) -> DataFrame:
    """(job, _end): the order of the first terminal poll of each job that has one."""
    over = polls.where(~is_active(state))
    return over.groupBy(job).agg(F.min(order).alias("_end")).where(F.col("_end").isNotNull())


def until_terminal(
    polls: DataFrame,
    job: str = "batch_id",
    order: str = "poll_seq",
    state: str = "state",
    hot_keys: int | None = None,
) -> DataFrame:
    """Polls up to and including the first terminal one of each job; at least one per job.

    ``hot_keys`` is the number of jobs whose polls may be spread out, see ``plans.skew``.
    """
    ended = F.when(~is_active(state), F.col(order))
    return (
        with_key_minimum(polls, job, order, ended, "_end", hot_keys)
        .where(F.col("_end").isNull() | (F.col(order) <= F.col("_end")))
        .drop("_end")
    )


def first_seen_lines(
    polls: DataFrame, job: str = "batch_id", order: str = "poll_seq", lines: str = "lines"
) -> DataFrame:
    """(job, order, pos, line): every distinct line of a job once, where it first appeared.

    The rank is cut to 1 before the shuffle, so a line that fills a log sends one row per task.
    Sort by (job, order, pos) to read the log.
    """
    # The plain explode would first filter on the size of the array, and so build an array that is
    # computed (a split text, a slice of a log) three times.
    exploded = polls.select(job, order, F.posexplode_outer(lines).alias("pos", "line"))
    first = Window.partitionBy(job, "line").orderBy(order, "pos")
    return (
        exploded.where(F.col("pos").isNotNull())
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def follow_totals(
    polls: DataFrame, job: str = "batch_id", total: str = "total", lines: str = "lines"
) -> DataFrame:
    """(job, total_lines, known_lines): sum of reported totals, number of distinct lines."""
    exploded = polls.select(job, total, F.posexplode_outer(lines).alias("pos", "line"))
    once = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col(total))
    return exploded.groupBy(job).agg(
        F.sum(once).alias("total_lines"), F.count_distinct("line").alias("known_lines")
    )


def seconds_between(start: Column, end: Column) -> Column:
    return (end - start).cast("interval second").cast("decimal(18,6)")


def poll_outcome(
    polls: DataFrame,
    timeout: float = 60,
    job: str = "batch_id",
    order: str = "poll_seq",
    state: str = "state",
    at: str = "ts",
) -> DataFrame:
    """(job, state, elapsed, timed_out) over polls that end at the first terminal state.

    ``timed_out``: an active state was observed more than ``timeout`` seconds after the first poll.
    """
    active_at = F.max(F.when(is_active(state), F.col(at)))
    facts = polls.groupBy(job).agg(
        F.max_by(state, order).alias("state"),
        F.min(at).alias("_first"),
        F.max(at).alias("_last"),
        active_at.alias("_active"),
    )
    first = F.col("_first")
    late = seconds_between(first, F.col("_active")) > F.lit(timeout)
    return facts.select(
        job,
        "state",
        seconds_between(first, F.col("_last")).alias("elapsed"),
        F.coalesce(late, F.lit(False)).alias("timed_out"),
    )


def first_app_id(
    polls: DataFrame,
    max_polls: int = 10,
    job: str = "batch_id",
    order: str = "poll_seq",
    app_id: str = "appId",
) -> DataFrame:
    """(job, appId): the first non-null id in the submit reply and at most ``max_polls`` polls.

    Each task keeps its first ``max_polls + 1`` rows of a job before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(job).orderBy(order))
    early = (
        polls.select(job, order, app_id)
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= max_polls + 1)
    )
    named = F.when(F.col(app_id).isNotNull(), F.col(order))
    return early.groupBy(job).agg(F.min_by(app_id, named).alias(app_id))


def log_checks(
    records: DataFrame,
    present: Mapping[str, str | Column] | None = None,
    absent: Mapping[str, str | Column] | None = None,
    log: str = "log",
) -> DataFrame:
    """Add a flag per check: the log contains, or does not contain, a literal or a row's column."""
    flags = {name: log_contains(log, text) for name, text in (present or {}).items()}
    flags |= {name: ~log_contains(log, text) for name, text in (absent or {}).items()}
    return records.withColumns(flags)
