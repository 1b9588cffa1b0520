"""Exact duplicates: groups of a 128-bit content hash whose bytes are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger.llm.tables import id_and_text, written
from jobledger.plans.bloom import maybe_among
from jobledger.plans.skew import lookup_join


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    hashed: Callable[[Column], Column] = content_hash,
    largest: bool = False,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Rows whose normalised texts are the same bytes are a group; the smallest id of it stays, or the
    largest. A null text counts as empty. An id that a group repeats counts as often as it stands in
    ``group_size`` and all its rows stay. Rows without an id stay only where no row of the group has
    one. An empty table gives no rows.

    Texts move only where a hash repeats: a Bloom filter of the repeated hashes, at the scan, keeps all
    others where they are. They are grouped by (hash, text), in every task before the shuffle, so a
    group of copies sends one row a task, and a hash with more than one text is a collision. Its rows,
    and only those, are grouped by text as well. Rows get the answer of their group by
    ``lookup_join``, which spreads those of a large group.
    """
    rows = id_and_text(docs, doc_id, text).select("doc_id", normalise(F.col("text")).alias("text"))
    rows = rows.select("doc_id", "text", hashed(F.col("text")).alias("hash"))
    narrow = written(
        rows.select("doc_id", "hash", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")),
        "exact-hashes",
    )
    repeated = narrow.groupBy("hash").count().where("count > 1").select("hash")
    repeated = written(repeated, "exact-repeated")
    # A hash that only the filter takes for a repeated one has a single text, so no collision.
    texts = maybe_among(rows.select("hash", "text"), repeated, "hash").distinct()
    collided = texts.groupBy("hash").count().where("count > 1").select("hash")
    collided = written(collided, "exact-collisions")

    tied = "hash", "variant"
    if collided.limit(1).count():
        # Bytes decide between texts of one hash. All others keep a null variant.
        bytes_of = rows.join(collided, "hash", "left_semi")
        bytes_of = bytes_of.select("doc_id", "hash", F.col("text").alias("variant"),
                                   F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
        plain = narrow.join(collided, "hash", "left_anti").withColumn("variant", F.lit(None).cast("string"))
        narrow = plain.unionByName(bytes_of)
    else:
        narrow = narrow.withColumn("variant", F.lit(None).cast("string"))
    best = F.max("doc_id") if largest else F.min("doc_id")
    narrow = narrow.select("doc_id", "text_sha256", F.struct(*tied).alias("group"))
    groups = narrow.groupBy("group").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # A group of one has its answer with it.
    several = groups.where("group_size > 1")
    found = lookup_join(narrow, several, "group", ["doc_id"])
    return found.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )
