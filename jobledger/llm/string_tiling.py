"""Benchmark decontamination by greedy string tiling.

A document is compared with an item of the benchmark if the two share a run of words, the seed. The
pair is tiled as running Karp-Rabin matching does it: for a falling search length, hashes of all runs
of unmarked words of that length are looked up, matches are extended, and the longest ones that do
not overlap are marked, until nothing of the least length is left. The share of the item's words that
is marked says how much of it the document holds, in whatever order its passages stand.

No task and no message holds the benchmark, so it may be of any size. Its seeds are a table. A sieve of
them, a Bloom filter of at most 32 MB, goes to the tasks that read documents, which make one pass;
what leaves it are the seeds that the sieve lets through and the words inside them, as no other word
can be part of a tile. These seeds are joined to those of the benchmark.

Phrases that many documents and items share would make a pair of each two. A pair that reaches the
threshold shares a known number of an item's seeds, so its most frequent ones, fewer than that number,
are left out of the join: a pair must share one of the others too. Pairs that cannot share enough of
them fall before any word of theirs moves. The rest is tiled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm import words as W
from jobledger.llm.tables import KEY, id_and_text, keyed, packed, unpacked, written
from jobledger.plans.skew import lookup_join

SIEVE_BITS = (22, 28)  # smallest and largest sieve, as a power of two; the latter is 32 MB
#: Items of a seed, and words of an item, up to which the answers for hot keys are broadcast. Fewer keys
#: than shuffle partitions are hot, which bounds the whole. Beyond, it is a join that Spark may split.
HOT_ITEMS, HOT_WORDS = 10_000, 10_000


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, as a difference of running sums."""
    up, down = W.powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return (sums[size:] - sums[:-size]) * down[: len(words) - size + 1]


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Whether each run of ``size`` words has no marked one."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return sums[size:] == sums[:-size]


def _matches(
    item: np.ndarray, text: np.ndarray, in_item: np.ndarray, in_text: np.ndarray, size: int
) -> list[tuple[int, int, int]]:
    """(length, place in item, place in text) of the maximal matches of unmarked words."""
    if size > min(len(item), len(text)):
        return []
    places = defaultdict(list)
    own, other = _runs(item, size), _runs(text, size)
    for i in np.flatnonzero(_free(in_item, size)):
        places[int(own[i])].append(int(i))
    candidates = np.flatnonzero(_free(in_text, size) & np.isin(other, own))
    found = []
    for j in candidates.tolist():
        for i in places.get(int(other[j]), ()):
            if i and j and item[i - 1] == text[j - 1] and not in_item[i - 1] and not in_text[j - 1]:
                continue  # part of the match that begins before
            length = 0
            while (
                i + length < len(item)
                and j + length < len(text)
                and item[i + length] == text[j + length]
                and not in_item[i + length]
                and not in_text[j + length]
            ):
                length += 1
            if length >= size:
                found.append((length, i, j))
    return found


def tiles(item: np.ndarray, text: np.ndarray, least: int, start: int = 20) -> list[tuple[int, int, int]]:
    """(length, place in item, place in text) of the tiles, longest matches first."""
    in_item, in_text = np.zeros(len(item), dtype=bool), np.zeros(len(text), dtype=bool)
    made = []
    size = max(least, min(start, len(item), len(text)))
    while True:
        found = _matches(item, text, in_item, in_text, size)
        longest = max(found, default=(0, 0, 0))[0]
        if longest > 2 * size:
            size = longest
            continue
        cut = False
        for length, i, j in sorted(found, key=lambda match: (-match[0], match[1], match[2])):
            if in_item[i : i + length].any() or in_text[j : j + length].any():
                cut = True  # what is left of it is found again
                continue
            in_item[i : i + length] = in_text[j : j + length] = True
            made.append((length, i, j))
        if cut:
            continue
        if size == least:
            return made
        size = max(least, size // 2)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """Arrow lists of 64-bit numbers."""
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64)))


def _list_at(column: pa.ListArray, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


_ITEMS = "item_id bigint, words array<bigint>, seeds array<bigint>, times array<bigint>"


def _items(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Hashed words of every item that has any, and its distinct seeds with their numbers of places."""
    for batch in batches:
        ids, words, seeds, times = [], [], [], []
        for item_id, text in zip(batch.column("doc_id"), W.text_bytes(batch.column("text"))):
            own, offsets = W.hashed_words([text])
            if len(own):
                found, often = np.unique(W.shingles(own, offsets, min(seed, len(own)))[0], return_counts=True)
                for values, value in zip((ids, words, seeds, times), (item_id.as_py(), own, found, often.astype(np.int64))):
                    values.append(value)
        columns = [pa.array(ids, pa.int64()), _lists(words), _lists(seeds), _lists(times)]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "words", "seeds", "times"])


def _sieve(seeds: DataFrame) -> np.ndarray:
    """A Bloom filter of ``seed`` with two bits for each, as bytes; it is bounded whatever their number."""
    least, most = SIEVE_BITS
    bits = min(most, max(least, (64 * seeds.count()).bit_length()))
    mask = F.lit((1 << bits) - 1)
    spots = F.array(F.col("seed").bitwiseAND(mask), F.shiftrightunsigned("seed", 36).bitwiseAND(mask))
    spots = seeds.select(F.explode(spots).alias("spot"))
    block, spot = F.shiftright("spot", 15), F.col("spot").bitwiseAND(F.lit((1 << 15) - 1))
    blocks = spots.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(spot.cast("int")).alias("bits"))
    sieve = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for row in blocks.toLocalIterator():
        sieve[row["block"] << 12 : (row["block"] + 1) << 12] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return sieve


def _passed(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that the sieve lets through."""
    mask = np.uint64(8 * len(sieve) - 1)

    def has(spots: np.ndarray) -> np.ndarray:
        return (sieve[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8)) & 1 == 1

    at = np.flatnonzero(has(hashes & mask))
    return at[has((hashes[at] >> np.uint64(36)) & mask)]


_SHARED = "doc_id bigint, _h bigint, seeds array<bigint>, places array<bigint>, words array<bigint>"


def _shared(batches: Iterator[pa.RecordBatch], sieve: np.ndarray, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Of every text with a seed that passes: such seeds, the places of words inside them, these words.

    A text of fewer words than a size is left to the pass of the size that it has.
    """
    for batch in batches:
        texts = W.text_bytes(batch.column("text"))
        rows, seeds, places, inner = [], [], [], []
        for low, high in W.parts(texts):
            words, offsets = W.hashed_words(texts[low:high])
            counts = np.diff(offsets)
            inside = np.zeros(len(words), dtype=bool)
            passed = defaultdict(list)
            for size in sizes:
                runs, ends = W.shingles(words, offsets, size)
                at = _passed(sieve, runs)
                text = np.searchsorted(ends, at, side="right") - 1
                at, text = at[counts[text] >= size], text[counts[text] >= size]
                for step in range(size):
                    inside[offsets[text] + at - ends[text] + step] = True
                for i in np.unique(text).tolist():
                    first, last = np.searchsorted(text, [i, i + 1])
                    passed[i].append(runs[at[first:last]])
            for i, found in passed.items():
                own = np.flatnonzero(inside[offsets[i] : offsets[i + 1]])
                rows.append(low + i)
                seeds.append(np.unique(np.concatenate(found)))
                places.append(own)
                inner.append(words[offsets[i] + own])
        keys = [batch.column(name).take(pa.array(rows, pa.int64())) for name in KEY]
        columns = [*keys, _lists(seeds), _lists(places), _lists(inner)]
        yield pa.RecordBatch.from_arrays(columns, [*KEY, "seeds", "places", "words"])


_FOUND = (
    "doc_id bigint, _h bigint, item_id bigint, coverage double, "
    "tiles array<struct<item_word:bigint,doc_word:bigint,words:bigint>>"
)


def _tiled(batches: Iterator[pa.RecordBatch], seed: int, threshold: float) -> Iterator[pa.RecordBatch]:
    tile = pa.list_(pa.struct([(name, pa.int64()) for name in ("item_word", "doc_word", "words")]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), tile]
    names = ["doc_id", "_h", "item_id", "coverage", "tiles"]
    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            pattern, shared = (_list_at(batch.column(name), k).view(np.uint64) for name in ("pattern", "words"))
            at = _list_at(batch.column("places"), k)
            # Words outside of every seed are part of no tile. A gap stands for them.
            gap = np.flatnonzero(np.diff(at) > 1) + 1
            outside = next(x for x in range(len(pattern) + 1) if x not in set(pattern.tolist()))
            shared = np.insert(shared, gap, np.uint64(outside))
            at = np.insert(at, gap, -1)
            made = tiles(pattern, shared, min(seed, len(pattern)))
            coverage = sum(length for length, _, _ in made) / len(pattern)
            if coverage >= threshold:
                spans = [
                    {"item_word": i, "doc_word": int(at[j]), "words": n} for n, i, j in sorted(made, key=lambda t: t[1])
                ]
                key = [batch.column(name)[k].as_py() for name in ("doc_id", "_h", "item_id")]
                rows.append((*key, coverage, spans))
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)] if rows else [pa.array([], kind) for kind in types]
        yield pa.RecordBatch.from_arrays(columns, names)


def _telling(items: DataFrame, hits: DataFrame, seed_words: int, threshold: float) -> DataFrame:
    """(seed, items): for every seed that documents have, the items (item, times, need) to try there.

    Tiles on ``threshold`` of an item of n words begin or go on at ``threshold`` * n / seed words of its
    seeds' places or more. An item leaves out its most frequent seeds as long as they have fewer places
    than that; ``need`` is how many places of the others a document must then share.
    """
    size = F.least(F.size("words"), F.lit(seed_words))
    enough = F.greatest(F.ceil(F.size("words") * threshold / size - 1e-9), F.lit(1))
    seeds = items.select("item", enough.alias("enough"), F.explode(F.arrays_zip("seeds", "times")).alias("own"))
    seeds = seeds.select("item", "enough", F.col("own.seeds").alias("seed"), F.col("own.times").alias("times"))
    often = hits.groupBy("seed").agg(F.count(F.lit(1)).alias("often"))
    seeds = seeds.join(often, "seed")
    by_often = Window.partitionBy("item").orderBy(F.desc("often"), "seed")
    up_to = F.sum("times").over(by_often.rowsBetween(Window.unboundedPreceding, 0))
    seeds = seeds.withColumn("out", F.when(up_to < F.col("enough"), F.col("times")).otherwise(0))
    need = F.col("enough") - F.sum("out").over(Window.partitionBy("item"))
    seeds = seeds.withColumn("need", need).where("out = 0")
    return seeds.groupBy("seed").agg(F.collect_list(F.struct("item", "times", "need")).alias("items"))


def _pairs(shared: DataFrame, items: DataFrame, seed_words: int, threshold: float) -> DataFrame:
    """(row, item) of the pairs that share enough seeds to reach the threshold."""
    hits = shared.select("row", F.explode("seeds").alias("seed"))
    telling = written(_telling(items, hits, seed_words, threshold), "tile-seeds")
    most = telling.agg(F.max(F.size("items"))).first()[0] or 0
    if most <= HOT_ITEMS:
        found = lookup_join(hits, telling, "seed", ["row"]).where("items IS NOT NULL")
    else:
        found = hits.join(telling, "seed")
    found = found.select("row", F.explode("items").alias("own")).groupBy("row", "own.item")
    found = found.agg(F.sum("own.times").alias("places"), F.max("own.need").alias("need"))
    return written(found.where("places >= need").select("row", "item"), "tile-pairs")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    seed_words: int = 5,
    threshold: float = 0.5,
) -> DataFrame:
    """(doc_id, _h, item_id, coverage, tiles): the pairs in which a document holds an item.

    Tiles of at least ``seed_words`` words cover ``threshold`` or more of the item's words; an item
    of fewer words must be there whole. ``_h`` is a hash of the text, which tells documents without
    an id apart; rows that repeat id and text give a row each. Items and documents without words
    match nothing, nor does an empty table.
    """
    items = id_and_text(benchmark, item_id, item_text).mapInArrow(lambda batches: _items(batches, seed_words), _ITEMS)
    # Items and documents get numbers that stay as they are once written.
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "tile-items")
    size = F.least(F.size("words"), F.lit(seed_words))
    known = items.agg(F.collect_set(size).alias("sizes"), F.max(F.size("words")).alias("longest")).first()
    sieve, sizes = _sieve(items.select(F.explode("seeds").alias("seed"))), sorted(known["sizes"])
    rows = keyed(docs, doc_id, text)
    shared = rows.mapInArrow(lambda batches: _shared(batches, sieve, sizes), _SHARED)
    shared = written(shared.withColumn("row", F.monotonically_increasing_id()), "tile-shared")
    pairs = _pairs(shared, items, seed_words, threshold)
    patterns = items.select("item", "item_id", F.col("words").alias("pattern"))
    if (known["longest"] or 0) <= HOT_WORDS:
        pairs = lookup_join(pairs, patterns, "item", ["row"])
    else:
        pairs = pairs.join(patterns, "item")
    tried = pairs.join(shared, "row").select(*KEY, "item_id", "pattern", "places", "words")
    return written(tried.mapInArrow(lambda batches: _tiled(batches, seed_words, threshold), _FOUND), "tiled")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters
) -> DataFrame:
    """The rows of ``docs``, all columns under whatever names, that hold no item of the benchmark.

    Rows with a null or empty text hold none and stay, as do all rows if the benchmark is empty; rows
    that repeat id and text fare alike. An empty table gives no rows.
    """
    found = contaminated(docs, benchmark, doc_id, text, **parameters).select(*KEY).distinct()
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
        packed(docs),
    )
    same = rows["id"].eqNullSafe(found["doc_id"]) & (rows["h"] == found["_h"])
    return unpacked(rows.join(found, same, "left_anti"), docs)
