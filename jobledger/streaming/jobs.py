"""The keyed state of a stream of polls: one row a job, in the engine's state store."""

from __future__ import annotations

import datetime
import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from jobledger.schemas import ACTIVE_STATES

# Workers get the processors as they are here and need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Names of the state variables; the state reader asks for them.
END, WATCH = "end", "watch"


def end_schema(order: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(END, order)])


class JobEnds(StatefulProcessor):
    """Latches where each job ended: the least order of its terminal polls, in any order of arrival.

    Takes rows (job, order, state) and gives a row (job, end) whenever the end of a job is new or
    moves to an earlier poll.
    """

    def __init__(self, job: str, order: str, state: str, order_type: T.DataType) -> None:
        self.names = job, order, state
        self.schema = end_schema(order_type)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.end = handle.getValueState(END, self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        job, order, state = self.names
        known = self.end.get()[0] if self.end.exists() else None
        least = known
        for row in rows:
            if row[state] not in ACTIVE_STATES and row[order] is not None and (least is None or row[order] < least):
                least = row[order]
        if least != known:
            self.end.update((least,))
            yield Row(**{job: key[0], END: least})

    def close(self) -> None:
        pass


class JobWatch(StatefulProcessor):
    """Tells of jobs that stay active for longer than a timeout, by their polls and by the clock.

    Takes rows (job, order, state, at). State is a row a job: while it runs, its first and its last
    active time and what was told of it; once it is over, only where it ended, so that later polls
    are known to be late. ``forget`` drops that too after so many seconds. Gives rows
    (job, waited, silent): as soon as polls show a longer wait than the timeout, and longer ones as
    they come; and once, with ``silent``, if a job that is not over had no poll for the timeout by
    the clock of the executors, with the time since its first poll came.
    """

    def __init__(
        self, job: str, order: str, state: str, at: str, order_type: T.DataType, timeout: float, forget: float | None
    ) -> None:
        self.names = job, order, state, at
        self.schema = end_schema(order_type)
        self.timeout = datetime.timedelta(seconds=timeout)
        self.forget = None if forget is None else int(forget * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.end = handle.getValueState(END, self.schema, self.forget)
        # Times in microseconds: of the first poll, of the last active one, the wait that was told,
        # and the clock in milliseconds when the job was first seen.
        self.watch = handle.getValueState(WATCH, "first long, active long, told long, since long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        job, order, state, at = self.names
        now = timerValues.getCurrentProcessingTimeInMs()
        end = self.end.get()[0] if self.end.exists() else None
        first, active, told, since = self.watch.get() if self.watch.exists() else (None, None, None, now)
        news = sorted((row for row in rows if row[order] is not None), key=lambda row: row[order])
        if end is not None:  # the state of a job that is over says no more than that
            over = [row[order] for row in news if row[state] not in ACTIVE_STATES and row[order] < end]
            if over:
                self.end.update((min(over),))
            return
        for row in news:
            if row[at] is not None:
                time = _micros(row[at])
                first = time if first is None else min(first, time)
                if row[state] in ACTIVE_STATES:
                    active = time if active is None else max(active, time)
            if row[state] not in ACTIVE_STATES:
                end = row[order]
                break
        waited = None if active is None else active - first
        if waited is not None and waited > _micros_of(self.timeout) and (told is None or waited > told):
            told = waited
            yield Row(**{job: key[0], "waited": waited, "silent": False})
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if end is not None:
            self.end.update((end,))
            self.watch.clear()
        else:
            self.watch.update((first, active, told, since))
            self.handle.registerTimer(now + int(self.timeout.total_seconds() * 1000))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.watch.exists():
            since = self.watch.get()[3]
            waited = (timerValues.getCurrentProcessingTimeInMs() - since) * 1000
            yield Row(**{self.names[0]: key[0], "waited": waited, "silent": True})

    def close(self) -> None:
        pass


_EPOCH = datetime.datetime(1970, 1, 1)


def _micros_of(span: datetime.timedelta) -> int:
    return span // datetime.timedelta(microseconds=1)


def _micros(time: datetime.datetime) -> int:
    """Microseconds of the clock time that a timestamp shows; only differences count."""
    return _micros_of(time.replace(tzinfo=None) - _EPOCH)
