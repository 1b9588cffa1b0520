"""Shared pieces: the two columns an operator reads, the key of a row, tables written on the way.

A document is known by its id and its text, so operators select these two under fixed names first;
whatever else a table holds, under whatever name, cannot clash with theirs. Rows that repeat both id
and text are one document, and rows without an id come before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger.plans.session import fresh_dir

KEY = ("doc_id", "_h")


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id long, text string), a null text as the empty one."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, _h, text) with a 64-bit hash of the text, which tells rows of one id apart."""
    rows = id_and_text(docs, doc_id, text)
    return rows.select("doc_id", F.xxhash64("text").alias("_h"), "text")


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one, ``row``, so that none clashes with an operator's own."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from the ``row`` of ``packed``."""
    return rows.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])


def same_key(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality on ``names`` (``KEY`` unless given)."""
    condition = F.lit(True)
    for name in names or KEY:
        condition &= left[name].eqNullSafe(right[name])
    return condition


def lower_ascii(text: str | Column) -> Column:
    """A-Z in lower case and every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` from a table in the shared folder: computed once, and safe from lost executors."""
    path = fresh_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
