"""Operators on job records: look up, compare, find name collisions, drop removed jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.plans.bloom import maybe_among
from jobledger.plans.skew import lookup_join
from jobledger.schemas import ACTIVE_STATES

# Fields that decide whether a record changed; the log does not.
COMPARED = ("name", "appId", "appInfo", "state")
# Distinct keys of a listing up to which it is broadcast.
FEW = 50_000


def is_active(state: Column | str = "state") -> Column:
    state = F.col(state) if isinstance(state, str) else state
    return state.isin(*ACTIVE_STATES)


def latest_records(records: DataFrame, arrival: str | Sequence[str], key: str = "id") -> DataFrame:
    """One record per key, the last by the columns of ``arrival``, the first of them first.

    The rank is cut to 1 before the shuffle too, so a key with many copies sends one per task.
    """
    columns = [arrival] if isinstance(arrival, str) else list(arrival)
    newest = Window.partitionBy(key).orderBy(*[F.col(column).desc() for column in columns])
    return (
        records.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def lookup(
    records: DataFrame, ids: DataFrame, key: str = "id", strict: bool = False, bloom: bool = False
) -> DataFrame:
    """The record of every distinct id asked for, with ``found``; ``strict`` raises on an unknown id.

    The records are first cut down to the ids, so only hits are shuffled. Where Spark knows the ids
    to be few, as it does for a table, that is a filter at the scan of the records. For ids of
    unknown size, such as the result of a query, ``bloom`` counts them and puts a Bloom filter of
    theirs there instead, so that hardly more than the hits reach a shuffle.
    """
    asked = ids.select(key).distinct()
    # A row that only the Bloom filter takes for a hit matches none of the ids below.
    hits = maybe_among(records, asked, key) if bloom else records.join(asked, key, "left_semi")
    hits = hits.withColumn("found", F.lit(True))
    answers = asked.join(hits, key, "left")
    found = F.coalesce("found", F.lit(False))
    if strict:
        unknown = F.raise_error(F.concat(F.lit("no such job: "), F.col(key).cast("string")))
        found = F.when(found, found).otherwise(unknown.cast("boolean"))
    return answers.withColumn("found", found)


def states(records: DataFrame, job: int | None = None) -> DataFrame:
    """(id, state) of one or all jobs; no other column is read."""
    chosen = records if job is None else records.where(F.col("id") == job)
    return chosen.select("id", "state")


def active(records: DataFrame) -> DataFrame:
    return records.where(is_active())


def drop_removed(records: DataFrame, removed: DataFrame, key: str = "id") -> DataFrame:
    """The records whose id was never removed. Removals are made distinct before they shuffle."""
    return records.join(removed.select(key).distinct(), key, "left_anti")


def name_collisions(
    new: DataFrame, known: DataFrame, order: str = "id", hot_keys: int | None = None
) -> DataFrame:
    """New jobs with ``taken_by``, the id of the job that has their name already, or null.

    That is the first known job of the name or, where none is known, the first of the new ones, to
    which its own name is free. Null names never collide; empty names do. Names are reduced to one id
    each before they shuffle, and a name that many new jobs share is spread over slots. All known
    jobs count, not just one page of them. Ids of new jobs are unique.
    """

    def first_of(jobs: DataFrame, place: int) -> DataFrame:
        named = jobs.where(F.col("name").isNotNull())
        by = F.struct(F.lit(place).alias("place"), F.col(order).alias("order"), F.col("id").alias("id"))
        return named.groupBy("name").agg(F.min(by).alias("first"))

    owners = first_of(known, 0).unionByName(first_of(new, 1)).groupBy("name").agg(F.min("first").alias("first"))
    owners = owners.select("name", F.col("first.id").alias("taken_by"), (F.col("first.place") == 1).alias("_new"))
    found = lookup_join(new, owners, "name", ["id"], hot_keys=hot_keys)
    own = F.col("_new") & (F.col("taken_by") == F.col("id"))
    taken = F.when(~F.coalesce(own, F.lit(False)), F.col("taken_by"))
    return found.withColumn("taken_by", taken).drop("_new")


def accepted(
    new: DataFrame, known: DataFrame, order: str = "id", hot_keys: int | None = None
) -> DataFrame:
    """New jobs whose name is free: not known, and of equal new names the first."""
    found = name_collisions(new, known, order, hot_keys)
    return found.where(F.col("taken_by").isNull()).drop("taken_by")


def known_ids(
    rows: DataFrame, listing: DataFrame, key: str, listing_key: str = "id", flag: str | None = None,
    spread_by: str | None = None, hot_keys: int | None = None,
) -> DataFrame:
    """Rows whose key is in the listing, or with ``flag`` all rows and a column that says so.

    A listing of up to ``FEW`` keys is broadcast, and nothing else moves. With a longer one a key of
    many rows is spread over slots by a hash of the whole row, or of ``spread_by``, a column that
    tells the rows of one key apart, where that is given.
    """
    known = listing.select(F.col(listing_key).alias(key)).distinct()
    few = known.limit(FEW + 1).count() <= FEW
    if flag is not None:
        known = known.withColumn(flag, F.lit(True))
    how = "left_semi" if flag is None else "left"
    if few:
        joined = rows.join(F.broadcast(known), key, how)
        return joined if flag is None else joined.select(*rows.columns, F.coalesce(flag, F.lit(False)).alias(flag))
    plain = [f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)]
    spread = [spread_by] if spread_by else plain
    joined = lookup_join(rows, known, key, spread, how, hot_keys)
    return joined if flag is None else joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def compare_snapshots(
    before: DataFrame, after: DataFrame, key: str = "id", fields: tuple[str, ...] = COMPARED
) -> DataFrame:
    """(id, change) with ``added``, ``removed``, ``same`` or ``changed``; equal nulls are the same.

    Both snapshots have one row per id. Only the compared fields reach the shuffle; tables of
    ``write_snapshot`` need none.
    """
    a = before.select(key, F.struct(*fields).alias("_a"))
    b = after.select(key, F.struct(*fields).alias("_b"))
    change = (
        F.when(F.col("_a").isNull(), F.lit("added"))
        .when(F.col("_b").isNull(), F.lit("removed"))
        .when(F.col("_a").eqNullSafe(F.col("_b")), F.lit("same"))
        .otherwise(F.lit("changed"))
    )
    return a.join(b, key, "full_outer").select(key, change.alias("change"))
