"""Joins and per-key facts in which no task ever holds all rows of a hot key.

One job may own a third of all polls, one name a third of all submissions. Keys are counted first,
with a partial count in every task. A key is hot if it has more rows than a shuffle partition has on
average, that is more than one in ``hot_keys`` of all rows, which is the number of shuffle partitions
unless the caller says otherwise. Fewer than ``hot_keys`` keys can be hot, whatever the data: that
bounds the broadcast of their answers. Rows of hot keys and of null keys are spread over slots, where
they match nothing else. All other rows join by key as usual.

Results are exact. The slot is a pure function of the row, so a task that is run again after a lost
executor sends the same rows to the same places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 16


def slot(*columns: str) -> Column:
    """A slot from the hash of the columns.

    Also the second join key of ordinary rows, from the key itself on both sides: Catalyst would
    take a constant out of the join keys, and with it the spreading of the hot rows. The low bits
    are never null, so the join adds no null check that would keep two branches from sharing a count.
    """
    return F.xxhash64(*columns).bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: Sequence[str],
    how: str = "left",
    hot_keys: int | None = None,
) -> DataFrame:
    """Join ``left`` to a ``right`` that has one row per key, with ``left`` free to be hot in a key.

    ``spread_by`` names columns of ``left`` that differ between the rows of one key.
    ``how`` is ``left``, ``left_semi`` or ``left_anti``.
    """
    added = [name for name in right.columns if name != on] if how == "left" else []
    answers = right.select(on, *added).withColumn("_match", F.lit(True))
    counts = left.groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    hot = _hot(counts, hot_keys).select(on)
    hot_answers = answers.join(F.broadcast(hot), on, "left_semi")
    joined = _hot_and_cold(
        left, hot.join(hot_answers, on, "left"), answers, on, spread_by, [*added, "_match"]
    )
    if how == "left_semi":
        joined = joined.where("_match")
    elif how == "left_anti":
        joined = joined.where("_match IS NULL")
    return joined.select(*left.columns, *added)


def with_key_minimum(
    rows: DataFrame,
    key: str,
    spread_by: str,
    value: Column,
    name: str,
    hot_keys: int | None = None,
) -> DataFrame:
    """Add to every row the minimum of ``value`` over all rows of its key (null if none)."""
    facts = rows.groupBy(key).agg(F.min(value).alias(name), F.count(F.lit(1)).alias("_n"))
    hot = _hot(facts, hot_keys)
    cold = facts.where(F.col(name).isNotNull())
    joined = _hot_and_cold(rows, hot, cold, key, [spread_by], [name])
    return joined.select(*rows.columns, name)


def _hot(counts: DataFrame, hot_keys: int | None) -> DataFrame:
    """The keys with more than one in ``hot_keys`` of the rows in ``_n``."""
    if hot_keys is None:
        hot_keys = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = counts.agg(F.sum("_n").alias("rows")).scalar()
    return counts.where(F.col("_n") * F.lit(hot_keys) > rows)


def _hot_and_cold(
    rows: DataFrame,
    hot: DataFrame,
    cold: DataFrame,
    key: str,
    spread_by: Sequence[str],
    added: Sequence[str],
) -> DataFrame:
    hot = hot.select(key, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in added])
    cold = cold.select(key, slot(key).alias("_slot"), *[F.col(c).alias(f"_cold_{c}") for c in added])
    alone = F.col("_hot").isNotNull() | F.col(key).isNull()
    # Slots from SLOTS on have no match.
    spread = F.when(alone, F.lit(SLOTS) + slot(*spread_by)).otherwise(slot(key))
    joined = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_slot", spread)
        .join(cold, [key, "_slot"], "left")
    )
    return joined.withColumns({c: F.coalesce(f"_hot_{c}", f"_cold_{c}") for c in added})
