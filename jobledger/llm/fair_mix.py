"""Mixing of sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated for as many epochs as its
target needs. The virtual finish time of a document is the number of tokens of its source up to and
including it, over the target of the source. Documents of all sources are put in the order of these
times and taken until the total budget is spent, so each source has sent nearly its share at any cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm.tables import packed, unpacked, written

BUCKET_ROWS = 20_000  # documents whose running sum one window group works out, on average
RANGES = 2_000  # ranges of the global order at most: Spark's choice of their ends takes a sample of each


def tokens(text: str) -> Column:
    """Number of runs of other characters than spaces, tabs and line ends; 0 for a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def cyclic_weight(rank: Column, weights: int) -> Column:
    """1, 2, .., weights, 1, 2, .. by rank from 1."""
    return (F.pmod(rank - 1, F.lit(weights)) + 1).cast("double")


def source_targets(
    sizes: DataFrame, weight: Callable[[Column], Column], share: float, most: int
) -> DataFrame:
    """(source, source_size, target): the budget poured over the sources by weight.

    ``sizes``: (source, source_size), one row a source; the budget is ``share`` of their sum. A
    target stops at ``most`` times the size, and what is over goes to the others by weight. In the
    order of size over weight the full sources come first, and the level of the rest is the one that
    the longest prefix of full sources leaves: the highest, as each full source taken out raises it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", weight(F.row_number().over(order)))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(most))
    full = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    rest = full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = ranked.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    left = F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(rest))
    open_ = F.col("level") * F.col("weight") <= F.col("most")
    ranked = ranked.withColumn("water", F.max(F.when(open_, F.col("level"))).over(everything))
    target = F.least(F.col("most"), F.col("water") * F.col("weight"))
    return ranked.select("source", "source_size", F.coalesce(target, F.col("most")).cast("double").alias("target"))


def in_ranges(rows: DataFrame, order: list[str], ranges: int) -> DataFrame:
    """``rows`` with ``_slice``, the number of their range: ranges of about equal counts in ``order``.

    The ends are quantiles of the whole order, not of its first column, so rows that agree in the
    first column are cut by the next ones. The table is written: numbers stay as they are.
    """
    dealt = rows.repartitionByRange(ranges, *order)
    return written(dealt.withColumn("_slice", F.spark_partition_id()), "mix-ranges")


def running_sum(rows: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group up to and including each row.

    ``_slice`` numbers slices of the rows that follow each other in ``order``. Rows are summed within
    slices and slices by their totals, so no task holds a group.
    """
    totals = rows.groupBy(*group, "_slice").agg(F.sum(value).alias("_in"))
    by = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_in").over(by), F.lit(0))).drop("_in")
    within = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_within", F.sum(value).over(within))
    same = rows["_slice"] == totals["_slice"]
    for column in group:
        same &= rows[column].eqNullSafe(totals[column])
    found = rows.join(totals, same).select(
        *[rows[c] for c in rows.columns], (F.col("_before") + F.col("_within")).alias(name)
    )
    return found.drop("_slice", "_within")


def fair_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: Callable[[Column], Column] = lambda rank: cyclic_weight(rank, 3),
    share: float = 1.0,
    most: int = 3,
    salt: str = "mix",
    size: Callable[[str], Column] = tokens,
) -> DataFrame:
    """(doc_id, _h, size, source_size, target, copies) of every row: how often the mix takes it.

    ``copies`` is at most ``most``. The shuffled order is that of a hash of salt, epoch, id and text,
    so reruns agree; rows that repeat id, source and text are one entry as often as they stand, and
    each of them is taken alike. A null source is a source of its own, the last one. A text without
    tokens costs nothing and goes with the place it has. An empty table gives no rows.
    """
    columns = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_h"),
        size(text).alias("size"),
    )
    rows = written(columns, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weight, share, most), "mix-targets")
    entries = rows.groupBy("doc_id", "source", "_h", "size").agg(F.count(F.lit(1)).alias("_times"))
    same = entries["source"].eqNullSafe(targets["source"])
    entries = entries.join(targets, same).select(*[entries[c] for c in entries.columns], "source_size", "target")

    # One epoch for each time the target holds the source, the last one cut short.
    epochs = F.least(F.ceil(F.col("target") / F.col("source_size")), F.lit(most)).cast("int")
    epochs = F.when(F.col("source_size") > 0, F.greatest(epochs, F.lit(1))).otherwise(1)
    queue = entries.withColumn("epoch", F.explode(F.sequence(F.lit(1), epochs)))
    mark = F.md5(F.concat_ws(":", F.lit(salt), "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_h"))
    queue = queue.withColumn("mark", mark).withColumn(
        "_place", F.conv(F.substring("mark", 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    )
    queue = queue.withColumn("cost", F.col("size") * F.col("_times"))
    queue = written(queue, "mix-queue")
    count = queue.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    buckets = max(1, -(-count // BUCKET_ROWS))
    # Places are even whatever the texts are, so equal steps of them hold equal counts of a source.
    place = F.least(F.floor(F.col("_place") * buckets), F.lit(buckets - 1)).cast("int")
    queue = queue.withColumn("_slice", place)
    queue = running_sum(queue, ["source", "epoch"], ["_place", "mark", "doc_id", "_h"], "cost", "sent")
    sent = F.col("sent") + (F.col("epoch") - 1) * F.col("source_size")
    finish = F.when(F.col("target") > 0, sent / F.col("target")).otherwise(F.col("_place"))
    queue = written(queue.withColumn("finish", finish), "mix-finish")

    budget = sizes.agg(F.sum("source_size") * F.lit(float(share))).first()[0] or 0.0
    # Finish times are not even: a source of empty texts has one for all of them.
    order = ["finish", "mark", "doc_id", "_h"]
    queue = in_ranges(queue, order, min(buckets, RANGES)).withColumn("_all", F.lit(0))
    queue = running_sum(queue, ["_all"], order, "cost", "total")
    taken = queue.groupBy("doc_id", "source", "_h").agg(
        F.count_if(F.col("total") <= budget).alias("copies")
    )
    same = F.lit(True)
    for column in ("doc_id", "source", "_h"):
        same &= rows[column].eqNullSafe(taken[column])
    found = rows.join(taken, same).select(*[rows[c] for c in rows.columns], "copies")
    same = found["source"].eqNullSafe(targets["source"])
    return found.join(targets, same).select(
        "doc_id", "_h", found["source"].alias("source"), "size", "source_size", "target", "copies"
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **parameters) -> DataFrame:
    """The rows of ``docs``, all columns under whatever names, as often as the mix takes each of them.

    Null texts are of size 0, and a missing source or id is one of its own. Rows that repeat id, text
    and source are taken as often as each other; texts of size 0 come by chance in the place that
    their mark gives them. An empty table gives no rows.
    """
    taken = fair_mix(docs, doc_id, text, source, **parameters)
    taken = taken.groupBy("doc_id", "_h", "source").agg(F.max("copies").alias("copies")).where("copies > 0")
    taken = written(taken, "mix-taken")
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("id"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("h"),
        F.col(source).cast("string").alias("from"),
        packed(docs),
    )
    same = (
        rows["id"].eqNullSafe(taken["doc_id"])
        & (rows["h"] == taken["_h"])
        & rows["from"].eqNullSafe(taken["source"])
    )
    found = rows.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return unpacked(found, docs)
