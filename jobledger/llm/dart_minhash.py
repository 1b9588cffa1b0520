"""Near-duplicates by DartMinHash signatures of weighted word shingles, joined by bands.

The weight of a shingle is how often its document repeats it, and similarity is the weighted
Jaccard index: the sum of the smaller weights over the sum of the larger ones.

Darts. The weight axis of every shingle is cut into regions [0, 1), [1, 2), [2, 4), [4, 8) and so on.
In each region darts arrive by a Poisson process in rank, as dense as the region is wide; times,
weights and coordinates of the darts are hashes of (shingle, region, number), so every document sees
the same darts. A document is hit by the darts below its weight and up to rank T / (its total
weight), about T = k ln k + 2 k darts however many shingles it has. Each of the k coordinates keeps
the dart of lowest rank; two documents agree in one with the probability of their similarity. If a
coordinate stays empty, the document is thrown at again up to twice the rank.

Join. Texts with the same words are one class member, found by a hash of the words. The others meet
in bands of the signature. In every band bucket all members are compared with the smallest one, which
gives a bucket of copies one pair a member. Buckets whose members are not in one component by then
are cut into blocks, and every two blocks are compared by one product of their shingle tables, of
which only the links that join components leave the task. So no link between members of a bucket is
lost, and no pairs are emitted. All similarities are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger.llm import words as W
from jobledger.llm.components import components
from jobledger.llm.tables import KEY, keyed, packed, unpacked, written

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 1.0 / (1 << 53)
BLOCK = 256  # members of a bucket that are compared in one table, against as many others


def _uniform(values: np.ndarray) -> np.ndarray:
    """(0, 1] from the upper bits of hashes."""
    return ((values >> np.uint64(11)).astype(np.float64) + 1.0) * _UNIT


def weighted_shingles(
    words: np.ndarray, offsets: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, how often) of every distinct shingle of every text, ordered by both."""
    found, ends = W.shingles(words, offsets, size)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    first = np.ones(len(found), dtype=bool)
    first[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(first)
    return text[at], found[at], np.diff(np.append(at, len(found)))


def signatures(
    text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, coordinates: int
) -> np.ndarray:
    """The dart of each coordinate of each text; texts without elements get zeros."""
    total = np.bincount(text, weights=weight, minlength=texts)
    darts = coordinates * math.log(coordinates) + 2.0 * coordinates
    reach = np.divide(darts, total, out=np.zeros(texts), where=total > 0)
    kept = np.zeros((texts, coordinates), dtype=np.uint64)
    todo = np.flatnonzero(total > 0)
    place = np.full(texts, -1, dtype=np.int64)
    while len(todo):
        place[:] = -1
        place[todo] = np.arange(len(todo))
        mine = place[text] >= 0
        found, filled = _throw(
            place[text[mine]], element[mine], weight[mine], reach[todo], len(todo), coordinates
        )
        done = filled.all(axis=1)
        kept[todo[done]] = found[done]
        todo = todo[~done]
        reach[todo] *= 2.0
    return kept


def _throw(
    text: np.ndarray,
    element: np.ndarray,
    weight: np.ndarray,
    reach: np.ndarray,
    texts: int,
    coordinates: int,
) -> tuple[np.ndarray, np.ndarray]:
    weight = weight.astype(np.float64)
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))), 0).astype(np.int64) + 1
    of = np.repeat(np.arange(len(text)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, np.exp2(level - 1.0), 0.0)
    width = np.where(level > 0, low, 1.0)
    seed = W.mix(element[of] + level.astype(np.uint64) * _GOLD)
    rank = np.zeros(len(of))
    number = 0
    cells, ranks, names = [], [], []
    while len(of):
        number += 1
        dart = W.mix(seed + np.uint64(number * int(_GOLD) % (1 << 64)))
        rank = rank - np.log(_uniform(dart)) / width
        near = rank <= reach[text[of]]
        of, low, width, seed, rank, dart = (x[near] for x in (of, low, width, seed, rank, dart))
        spot = W.mix(dart ^ _GOLD)
        hit = low + _uniform(spot) * width <= weight[of]
        coordinate = (W.mix(spot) % np.uint64(coordinates)).astype(np.int64)
        cells.append((text[of] * coordinates + coordinate)[hit])
        ranks.append(rank[hit])
        names.append(dart[hit])
    cell = np.concatenate(cells) if cells else np.zeros(0, dtype=np.int64)
    order = np.argsort(-np.concatenate(ranks)) if cells else cell
    found = np.zeros(texts * coordinates, dtype=np.uint64)
    filled = np.zeros(texts * coordinates, dtype=bool)
    if cells:
        cell = cell[order]
        found[cell] = np.concatenate(names)[order]  # the earliest dart is written last
        filled[cell] = True
    return found.reshape(texts, coordinates), filled.reshape(texts, coordinates)


def _signed(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """A 128-bit hash of the words of each text in order, null where it has none, and its bands."""
    for batch in W.short(batches):
        texts = W.text_bytes(batch.column("text"))
        for first, last in W.parts(texts):
            words, offsets = W.hashed_words(texts[first:last])
            text, shingle, often = weighted_shingles(words, offsets, size)
            signed = signatures(text, shingle, often, last - first, bands * rows)
            band = np.zeros((last - first, bands), dtype=np.uint64)
            for b in range(bands):
                for column in range(b * rows, (b + 1) * rows):
                    band[:, b] = W.mix(band[:, b] * _GOLD + signed[:, column] + np.uint64(b))
            none = np.diff(offsets) == 0
            columns = [batch.column(name).slice(first, last - first) for name in KEY]
            for salt in (1, 2):
                hashed = _sequence_hash(words, offsets, np.uint64(salt << 40))
                columns.append(pa.array(hashed.view(np.int64), mask=none))
            ends = pa.array(np.arange(0, band.size + 1, bands, dtype=np.int32))
            columns.append(pa.ListArray.from_arrays(ends, pa.array(band.reshape(-1).view(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, [*KEY, "w1", "w2", "bands"])


def _sequence_hash(words: np.ndarray, offsets: np.ndarray, salt: np.uint64) -> np.ndarray:
    """A polynomial over the words of each text."""
    at = np.arange(len(words)) - np.repeat(offsets[:-1], np.diff(offsets))
    up, _ = W.powers(int(at.max(initial=0)) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(W.mix(words + salt) * up[at], out=sums[1:])
    return W.mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def _similar(batches: Iterator[pa.RecordBatch], size: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """The links among candidate pairs: exact weighted Jaccard of both texts."""
    for batch in batches:
        texts = [
            text
            for pair in zip(W.text_bytes(batch.column("text_a")), W.text_bytes(batch.column("text_b")))
            for text in pair
        ]
        linked = []
        for first, last in W.parts(texts):
            first, last = first - first % 2, last - last % 2  # whole pairs
            if first == last:
                continue
            words, offsets = W.hashed_words(texts[first:last])
            text, shingle, often = weighted_shingles(words, offsets, size)
            pair = text // 2
            order = np.lexsort((shingle, pair))
            pair, shingle, often = pair[order], shingle[order], often[order]
            shared = (pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1])
            both = np.bincount(
                pair[1:][shared],
                weights=np.minimum(often[1:], often[:-1])[shared],
                minlength=(last - first) // 2,
            )
            total = np.bincount(pair, weights=often, minlength=(last - first) // 2)
            linked.append((total > 0) & (both >= threshold * (total - both) - 1e-9))
        keep = pa.array(np.concatenate(linked)) if linked else pa.array([], pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"]
        )


def _verified(pairs: DataFrame, members: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (a, b) of members that are similar enough."""
    first = members.select(F.col("member").alias("a"), F.col("text").alias("text_a"))
    second = members.select(F.col("member").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(lambda batches: _similar(batches, size, threshold), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 5,
    threshold: float = 0.8,
    bands: int = 25,
    rows: int = 5,
) -> DataFrame:
    """(doc_id, _h, class_id, class_h, n_rows): the near-duplicate class of every document.

    ``_h`` is the hash of the text, so that documents without an id and those that share one are
    told apart; ``n_rows`` counts the rows that repeat both. A class is named by the smallest key in
    it, ``class_id`` and ``class_h``, a missing id before all others. Two documents are in one class
    if a chain of links joins them. A link is an equal sequence of words, or a similarity of
    ``threshold`` or more. A document without words is in a class of its own, a text shorter than a
    shingle is one shingle. With the default of 25 bands of 5 coordinates a pair as similar as 0.8
    shares no band once in twenty thousand times. An empty table gives no rows.
    """
    docs = keyed(docs, doc_id, text)
    signed = written(
        docs.mapInArrow(
            lambda batches: _signed(batches, shingle_words, bands, rows),
            "doc_id bigint, _h bigint, w1 bigint, w2 bigint, bands array<bigint>",
        ),
        "near-signed",
    )
    # A member stands for all documents with its words. Its number is fixed by writing it.
    members = signed.where("w1 IS NOT NULL").groupBy("w1", "w2")
    members = members.agg(F.min(F.struct(*KEY)).alias("least"), F.any_value("bands").alias("bands"))
    members = written(members.withColumn("member", F.monotonically_increasing_id()), "near-members")
    slots = members.select("member", F.explode("bands").alias("bucket"))
    # A bucket of one member holds no candidates.
    heads = slots.groupBy("bucket").agg(F.min("member").alias("head"), F.count(F.lit(1)).alias("n"))
    heads = heads.where("n > 1").drop("n")
    slots = written(slots.join(heads, "bucket"), "near-slots")

    pairs = slots.where("member <> head").select(F.col("head").alias("a"), F.col("member").alias("b"))
    pairs = written(pairs.distinct(), "near-pairs")
    texts = _texts(docs, members.join(slots.select("member").distinct(), "member", "left_semi"))
    links = written(_verified(pairs, texts, shingle_words, threshold), "near-links")
    roots = components(links)
    placed = _mixed(slots, roots)
    if placed.limit(1).count():
        again = _joined(placed, texts, shingle_words, threshold)
        roots = components(links.unionByName(written(again, "near-joined")))
    return _classes(signed, members, roots)


def _texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(member, text) of the given members, written."""
    keys = members.select("member", "least.*")
    same = docs["doc_id"].eqNullSafe(keys["doc_id"]) & (docs["_h"] == keys["_h"])
    return written(docs.join(keys, same).select("member", "text").dropDuplicates(["member"]), "near-texts")


def _mixed(slots: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, i, j, member, root): the members of buckets of two components and more, by block.

    A bucket of ``BLOCK`` members is one block; of more, a member is sent to every pair (i, j) of
    blocks with its own.
    """
    placed = slots.select("bucket", "member").join(
        roots.withColumnRenamed("node", "member"), "member", "left"
    )
    placed = placed.select("bucket", "member", F.coalesce("root", "member").alias("root"))
    mixed = placed.groupBy("bucket").agg(
        F.min("root").alias("lo"),
        F.max("root").alias("hi"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
    )
    placed = placed.join(mixed.where("lo < hi").select("bucket", "blocks"), "bucket")
    own = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: other != own)
    placed = placed.withColumn("other", F.explode(F.when(F.col("blocks") > 1, others).otherwise(F.array(own))))
    placed = placed.select(
        "bucket", F.least(own, "other").alias("i"), F.greatest(own, "other").alias("j"), "member", "root"
    )
    return written(placed, "near-mixed")


def _joined(placed: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Links (a, b) that join components of a bucket."""
    rows = placed.join(texts, "member").repartition("bucket", "i", "j")
    rows = rows.sortWithinPartitions("bucket", "i", "j")
    return rows.mapInArrow(lambda batches: _block_links(batches, size, threshold), "a bigint, b bigint")


def _block_links(batches: Iterator[pa.RecordBatch], size: int, threshold: float) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    key = None
    links: list[tuple[int, int]] = []
    for batch in batches:
        names = ["bucket", "i", "j", "member", "root"]
        rows = zip(*(batch.column(name).to_pylist() for name in names), W.text_bytes(batch.column("text")))
        for *group, member, root, text in rows:
            if group != key and held:
                links += _spanning(held, size, threshold)
                held = []
            key = group
            held.append((member, root, text))
        yield _link_batch(links)
        links = []
    if held:
        yield _link_batch(_spanning(held, size, threshold))


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = list(zip(*links)) if links else [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], ["a", "b"])


def _spanning(held: list[tuple], size: int, threshold: float) -> list[tuple[int, int]]:
    """Of the links among the members, those of a tree over the components they join."""
    members = np.array([member for member, _, _ in held])
    _, root = np.unique([root for _, root, _ in held], return_inverse=True)
    if root.max() == 0:
        return []
    similar = _similarities([text for _, _, text in held], size) >= threshold - 1e-12
    similar &= root[:, None] != root[None, :]
    links = []
    group = root.copy()
    for i in range(len(members)):
        for j in np.flatnonzero(similar[i] & (group != group[i])):
            if group[j] != group[i]:
                links.append((int(members[i]), int(members[j])))
                group[group == group[j]] = group[i]
    return links


def _similarities(texts: list[bytes], size: int) -> np.ndarray:
    """Weighted Jaccard index of every two texts: a product of tables of (shingle, copy) columns."""
    words, offsets = W.hashed_words(texts)
    text, shingle, often = weighted_shingles(words, offsets, size)
    of = np.repeat(np.arange(len(text)), often)
    copy = np.arange(len(of)) - np.repeat(np.cumsum(often) - often, often)
    text, shingle = text[of], W.mix(shingle[of] + W.mix(copy.astype(np.uint64)))
    total = np.bincount(text, minlength=len(texts)).astype(np.float32)
    order = np.argsort(shingle, kind="stable")
    text, shingle = text[order], shingle[order]
    new = np.ones(len(shingle), dtype=bool)
    new[1:] = shingle[1:] != shingle[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else new  # others are in no intersection
    text, column = text[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    both = np.zeros((len(texts), len(texts)), dtype=np.float32)
    width = max(1, (1 << 22) // len(texts))
    columns = int(column.max(initial=-1)) + 1
    for first in range(0, columns, width):
        low, high = np.searchsorted(column, [first, first + width])
        table = np.zeros((len(texts), min(width, columns - first)), dtype=np.float32)
        table[text[low:high], column[low:high] - first] = 1.0
        both += table @ table.T
    return both / np.maximum(total[:, None] + total[None, :] - both, 1.0)


def _classes(signed: DataFrame, members: DataFrame, roots: DataFrame) -> DataFrame:
    placed = members.select("w1", "w2", "least", "member").join(
        roots.withColumnRenamed("node", "member"), "member", "left"
    )
    placed = placed.select("w1", "w2", "least", F.coalesce("root", "member").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("name"))
    named = placed.join(names, "root").select("w1", "w2", "name")
    keys = signed.groupBy(*KEY, "w1", "w2").agg(F.count(F.lit(1)).alias("n_rows"))
    found = keys.join(named, ["w1", "w2"], "left")
    name = F.coalesce("name", F.struct(*KEY))
    found = found.select(*KEY, name.alias("name"), "n_rows")
    return found.select(
        *KEY, F.col("name.doc_id").alias("class_id"), F.col("name._h").alias("class_h"), "n_rows"
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters: float
) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each class: the smallest id.

    A row without an id comes before all others, and of rows that repeat id and text one stays.
    """
    classes = near_duplicates(docs, doc_id, text, **parameters)
    first = classes.where("doc_id <=> class_id AND _h = class_h")
    first = written(first.select(*KEY, "n_rows"), "near-first")
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
        packed(docs),
    )
    kept = rows.join(first, rows["id"].eqNullSafe(first["doc_id"]) & (rows["h"] == first["_h"]))
    kept = kept.select("id", "h", "row", "n_rows")
    single = kept.where("n_rows = 1").select("row")
    repeated = kept.where("n_rows > 1").dropDuplicates(["id", "h"]).select("row")
    return unpacked(single.unionByName(repeated), docs)
