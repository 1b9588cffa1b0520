"""Functions on a log, an array of lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobledger.schemas import STDERR_MARKER


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also inside the lambda of an array function."""
    return F.get(F.transform(F.array(value), body), 0)


def split_log(log: Column | str, strict: bool = False) -> Column:
    """Struct (stdout, stderr, status): the lines before the stderr header, and the rest with it.

    Without a header both parts are null and the status is ``no_marker``; ``strict`` raises.
    """
    log = _col(log)
    at = F.array_position(log, STDERR_MARKER).cast("int")
    found = at > 0
    missing = F.raise_error(F.lit("log has no stderr header")) if strict else F.lit("no_marker")
    return F.struct(
        F.when(found, F.slice(log, F.lit(1), at - 1)).alias("stdout"),
        F.when(found, F.slice(log, at, F.size(log) - at + 1)).alias("stderr"),
        F.when(found, F.lit("ok")).otherwise(missing).alias("status"),
    )


def render_log(lines: Column | str) -> Column:
    return F.array_join(_col(lines), "\n")


def tail(log: Column | str, n: int = 100) -> Column:
    """The last ``n`` lines; all of them if there are fewer."""
    log = _col(log)
    return F.slice(log, F.greatest(F.size(log) - n, F.lit(0)) + 1, F.lit(n))


def log_page(log: Column | str, start: int | None = None, size: int | None = None) -> Column:
    """``size`` lines from offset ``start``. Only ``None`` means default, so a size of 0 gives none."""
    log = _col(log)
    first = F.lit((start or 0) + 1)
    length = F.size(log) if size is None else F.lit(size)
    return F.slice(log, first, length)


def log_contains(log: Column | str, text: Column | str) -> Column:
    """Whether the joined log contains ``text``: a literal string or a column of the same row."""
    needle = F.lit(text) if isinstance(text, str) else text
    return F.contains(render_log(log), needle)
