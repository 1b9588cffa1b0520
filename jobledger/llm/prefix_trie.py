"""The trie of the turns that conversations begin with, by blocks of turns.

A conversation is cut into blocks of a few turns, and a prefix is known by the digests of its blocks
put together (128 bits of exclusive or over digests that depend on the place). Conversations are
grouped by successive block digests first: rows (prefix before a block, prefix after it) with the
number of conversations. Where all conversations that go on from a prefix go on with one block,
every turn in it has the same conversations and is a node as it stands. Only blocks in which siblings
diverge are taken apart, one block of each kind, and their turns grouped again.

What a node has to know of its subtree is a sum over its conversations, so no level waits for another
and depth does not matter. The leaves below it are its conversations that stand for a leaf, the first
of each. A text below it counts once for each conversation but the smallest, which owns the node: a
conversation adds the characters from the node on to where it begins to own nodes itself.

A conversation may hold a third of all turns, a prefix or an end a third of all conversations. Turns
are numbered and digests run on over ranges of (conversation, order) that split a long conversation;
tables of one row a range carry the sums over. Joins on prefixes go through ``lookup_join``. Texts
are read once; what moves is a digest, a place and a length for each turn. The hash over the ids of
conversations with one end takes them one after the other, as its definition does: they stream
through a task and are not held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm.tables import written
from jobledger.plans.skew import lookup_join

BLOCK = 4
#: Rows that one repeated turn is written out in at a time.
_REPEATS = 4096


def _running(rows: DataFrame, key: str, order: Sequence[str], totals: dict[str, Column], label: str) -> DataFrame:
    """``rows`` with running totals (``totals``: name to a sum or exclusive or) within ``key``.

    ``totals`` are aggregates that can be put together with themselves: the parts of a key that is
    in several ranges are. Written to the shared folder, as the numbers of the ranges must not change.
    """
    dealt = rows.repartitionByRange(key, *order).withColumn("_slab", F.spark_partition_id())
    dealt = written(dealt, label)
    parts = dealt.groupBy(key, "_slab").agg(*[total.alias(f"_{name}") for name, total in totals.items()])
    # Only the first and the last key of a range can be in another one, so this is two rows a range.
    several = parts.groupBy(key).agg(F.min("_slab").alias("_first"), F.max("_slab").alias("_last"))
    several = several.where(F.col("_first") < F.col("_last")).select(key)
    parts = parts.join(several, key, "left_semi")
    before = Window.partitionBy(key).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    combine = {name: F.bit_xor if name.startswith("x_") else F.sum for name in totals}
    carried = parts.select(key, "_slab", *[combine[name](f"_{name}").over(before).alias(f"_{name}") for name in totals])
    within = Window.partitionBy(key, "_slab").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.withColumns({name: total.over(within) for name, total in totals.items()})
    joined = local.join(F.broadcast(carried), [key, "_slab"], "left")
    done = {}
    for name in totals:
        past = F.coalesce(f"_{name}", F.lit(0))
        done[name] = F.col(name).bitwiseXOR(past) if name.startswith("x_") else F.col(name) + past
    return joined.withColumns(done).select(*rows.columns, *totals)


def placed_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, pos, digest, chars): the turns of every conversation numbered from 1.

    They are in the order of ``turn``, a missing one first, equal ones by digest of role and text; a
    null role or text is an empty one. Rows repeated in full are a turn each. Rows without a
    conversation are left out. ``chars`` are the code points of the text.
    """
    role_, text_ = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    content = F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(content.cast("binary"))).alias("digest"),
        F.length(text_).cast("bigint").alias("chars"),
    )
    # A turn that is repeated is counted before it moves, and written out again afterwards.
    rows = rows.groupBy("conv_id", "turn", "digest", "chars").agg(F.count(F.lit(1)).alias("n"))
    last = _running(rows, "conv_id", ["turn", "digest"], {"last": F.sum("n")}, "trie-turns")
    chunks = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"), F.lit(_REPEATS).cast("bigint")))
    rest = last.select("conv_id", "digest", "chars", (F.col("last") - F.col("n")).alias("before"), "n", chunks.alias("i"))
    each = F.explode(F.sequence("i", F.least(F.col("i") + _REPEATS - 1, "n")))
    return rest.select("conv_id", "digest", "chars", "before", each.alias("j")).select(
        "conv_id", (F.col("before") + F.col("j")).alias("pos"), "digest", "chars"
    )


def grafted(turns: DataFrame, every: int = 100, kinds: int = 6) -> DataFrame:
    """Conversations that begin like another one, as a rehearsal on data without any.

    The first h turns of c become those of conversation c - c % ``every``, all of them if it has
    fewer, none if there is none; h is the crc32 of c as text modulo ``kinds``.
    """
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % kinds
    first = turns.where((c % every == 0) & (F.col("pos") < kinds))
    given = first.groupBy(c.alias("head")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "chars"))).alias("given"))
    known = turns.select("conv_id").distinct().select("conv_id", (c - c % every).alias("head"), h.alias("h"))
    some = F.explode(F.slice("given", F.lit(1), F.col("h").cast("int"))).alias("t")
    begun = known.join(given, "head").select("conv_id", some).select("conv_id", "t.pos", "t.digest", "t.chars")
    own = turns.where(F.col("pos") > h).withColumn("head", c - c % every)
    sizes = given.select("head", F.size("given").cast("bigint").alias("n_given"))
    own = lookup_join(own, sizes, "head", ["conv_id", "pos"])
    kept = F.least(h, F.coalesce("n_given", F.lit(0)))
    own = own.select("conv_id", (F.col("pos") - h + kept).alias("pos"), "digest", "chars")
    return begun.unionByName(own)


def _blocks(turns: DataFrame, size: int) -> DataFrame:
    """(conv_id, k, start, end, turns, c_start, c_end): every block of a conversation with the
    prefixes before and after it, the characters up to there, and its turns (pos, a, b, chars)."""
    row = F.struct(
        "pos", F.xxhash64("digest", "pos").alias("a"), F.xxhash64("pos", "digest").alias("b"), "chars"
    ).alias("t")
    grouped = turns.select("conv_id", F.floor((F.col("pos") - 1) / size).cast("bigint").alias("k"), row)
    grouped = grouped.groupBy("conv_id", "k").agg(
        F.array_sort(F.collect_list("t")).alias("turns"),
        F.bit_xor("t.a").alias("a"),
        F.bit_xor("t.b").alias("b"),
        F.sum("t.chars").alias("chars"),
    )
    totals = {"x_a": F.bit_xor("a"), "x_b": F.bit_xor("b"), "c_end": F.sum("chars")}
    run = _running(grouped, "conv_id", ["k"], totals, "trie-blocks")
    start = F.struct(F.col("x_a").bitwiseXOR(F.col("a")).alias("a"), F.col("x_b").bitwiseXOR(F.col("b")).alias("b"))
    return run.select(
        "conv_id",
        "k",
        start.alias("start"),
        F.struct(F.col("x_a").alias("a"), F.col("x_b").alias("b")).alias("end"),
        "turns",
        (F.col("c_end") - F.col("chars")).alias("c_start"),
        "c_end",
    )


def _nodes(variants: DataFrame) -> DataFrame:
    """(id, parent, depth, c_before, n_convs, conv_id, x, own_x, leaves) from blocks
    (start, end, turns, c_start, n_convs, conv_id, x, own_x, leaves, diverges)."""

    def upto(i: Column, name: str) -> Column:
        part = F.slice("turns", F.lit(1), i)
        return F.aggregate(part, F.col(f"start.{name}"), lambda s, t: s.bitwiseXOR(t[name]))

    def at(i: Column) -> Column:
        return F.struct(upto(i, "a").alias("a"), upto(i, "b").alias("b"))

    exploded = variants.select("*", F.posexplode("turns").alias("i", "t"))
    chars = F.aggregate(F.slice("turns", F.lit(1), F.col("i")), F.col("c_start"), lambda s, t: s + t["chars"])
    carried = ["n_convs", "conv_id", "x", "own_x", "leaves"]
    turns = exploded.select(
        at(F.col("i") + 1).alias("id"), at(F.col("i")).alias("parent"), F.col("t.pos").alias("depth"),
        chars.alias("c_before"), *carried, "diverges",
    )
    straight = turns.where("NOT diverges").drop("diverges")
    owner = F.min(F.struct("conv_id", "own_x"))
    refined = turns.where("diverges").groupBy("id", "parent", "depth", "c_before").agg(
        F.sum("n_convs").alias("n_convs"), owner.alias("_o"), F.sum("x").alias("x"), F.sum("leaves").alias("leaves")
    )
    refined = refined.select(
        "id", "parent", "depth", "c_before", "n_convs", "_o.conv_id", "x", "_o.own_x", "leaves"
    )
    return straight.unionByName(refined)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): the hash of the ids of the conversations that end at each prefix."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "ends_sha256"]
        now, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for a, b, conv in zip(*(column.to_pylist() for column in batch.columns)):
                if now == (a, b):
                    state.update(b",%d" % conv)
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(b"%d" % conv)
            if done:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, state.hexdigest())], names=names)

    sorted_ = ends.select("end.a", "end.b", "conv_id").repartition("a", "b").sortWithinPartitions("a", "b", "conv_id")
    found = sorted_.mapInArrow(hashed, "a bigint, b bigint, ends_sha256 string")
    return found.select(F.struct("a", "b").alias("id"), "ends_sha256")


def prefix_trie(members: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    for every prefix of the conversations ``members`` (conv_id, distinct), from the empty one on.

    ``turns`` has (conv_id, pos, digest, chars) with pos from 1 without gaps; members without turns
    end at the root. ``conv_id`` is the smallest conversation that begins with the prefix,
    ``parent_conv_id`` that of the prefix without its last turn, null for the root. ``n_leaves`` and
    ``saved_tokens`` are over the subtree with its top: prefixes that no longer one follows, and each
    prefix's characters in its last text times its conversations but one. ``ends_sha256`` is over the
    ascending ids of the conversations that are the prefix, as text with commas between; without any
    it is that of the empty text. No members give no rows.
    """
    members = members.select("conv_id")
    blocks = written(_blocks(turns, block), "trie-runs")
    variants = blocks.groupBy("start", "end").agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.first("turns").alias("turns"),
        F.first("c_start").alias("c_start"),
    )
    ways = variants.groupBy("start").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1")
    variants = lookup_join(variants, ways, "start", ["end"])
    variants = written(variants.withColumn("diverges", F.col("ways").isNotNull()).drop("ways"), "trie-variants")

    # Who is at a prefix, and since which prefix each conversation is the smallest.
    zero = F.lit(0).cast("bigint")
    nothing = {"x": zero, "own_x": zero, "leaves": zero}
    nodes = _nodes(variants.withColumns(nothing)).select("id", "depth", "c_before", "n_convs", "conv_id")
    empty = F.struct(zero.alias("a"), zero.alias("b"))
    root = members.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    top = root.select(empty.alias("id"), zero.alias("depth"), zero.alias("c_before"), "n_convs", "conv_id")
    nodes = written(nodes.unionByName(top), "trie-nodes")
    owned = nodes.groupBy("conv_id").agg(F.min_by("c_before", "depth").alias("x"))
    ended = blocks.groupBy("conv_id").agg(F.max_by(F.struct("end", "c_end"), "k").alias("e"))
    ended = members.join(ended, "conv_id", "left").select(
        "conv_id", F.coalesce("e.end", empty).alias("end"), F.coalesce("e.c_end", zero).alias("total")
    )
    ended = written(ended, "trie-ends")
    stops = ended.groupBy(F.col("end").alias("id")).agg(F.count(F.lit(1)).alias("n_ends"))
    leaves = nodes.join(stops, "id").where("n_convs = n_ends").select("conv_id", F.lit(1).cast("bigint").alias("leaves"))
    weights = ended.join(owned, "conv_id", "left").join(leaves, "conv_id", "left").select(
        "conv_id", F.coalesce("x", "total").alias("x"), F.coalesce("leaves", zero).alias("leaves")
    )
    weights = written(weights, "trie-weights")

    # The same groups once more, with the sums over their conversations.
    sums = [
        F.sum("x").alias("x"), F.min(F.struct("conv_id", "x"))["x"].alias("own_x"), F.sum("leaves").alias("leaves")
    ]
    weighed = lookup_join(blocks.select("conv_id", "k", "end"), weights, "conv_id", ["k"]).groupBy("end").agg(*sums)
    nodes = _nodes(variants.join(weighed, "end"))
    top = weights.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), *sums).where("n_convs > 0")
    top = top.select(
        empty.alias("id"), F.lit(None).cast("struct<a:bigint,b:bigint>").alias("parent"), zero.alias("depth"),
        zero.alias("c_before"), "n_convs", "conv_id", "x", "own_x", "leaves",
    )
    nodes = written(nodes.unionByName(top), "trie-weighed")
    saved = F.col("x") - F.col("own_x") - (F.col("n_convs") - 1) * F.col("c_before")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = lookup_join(nodes, parents, "parent", ["id"])
    found = found.join(children, "id", "left").join(_end_hashes(ended), "id", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
