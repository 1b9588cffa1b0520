"""Removal of byte strings that occur earlier, by doubling ranks of positions.

A position is removable if the ``length`` bytes (100) that begin there also begin earlier: in a
document of smaller id, or before it in its own. What removable positions cover is removed.

Ranking every position of a text takes twenty times its size in sorted pairs, so ranks are worked out
in three rounds over fewer and fewer positions, without losing one. A round gives runs of windows, of
``length`` bytes each, the rank pair (bytes that every window of the run has, bytes of the whole run).
A run whose first rank is unique ends there, and so do its windows. A run that is equal to an earlier
one is past the threshold: all its windows are removable. Only the first of equal runs goes on, and
only if its first rank also stands in other runs; it is cut up for the next round.

1. Blocks. Of the strings of ``anchor`` bytes (24) in each window, the one with the smallest hash is its
   anchor, so equal windows have equal anchors wherever they stand. Consecutive windows with one
   anchor, about 39, are a run; the anchor is what all of them have.
2. Parts. Windows that begin 0 to 7 bytes before the anchor, 8 to 15 and so on; all but seven bytes
   of a window are common to a part.
3. Windows. Here the pair is of the ranks of the two halves, as in any round of prefix doubling.

Ranks are 64-bit hashes, so a pair has 128 bits, and Spark sorts the pairs. Runs that one task sees
more than once are ranked there and sent once; a passage that a third of all documents share sends a
row a batch, and a phrase that they share in differing surroundings a row a place, which no task gathers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobledger.llm import words as W
from jobledger.llm.tables import keyed, written
from jobledger.plans.bloom import maybe_among
from jobledger.plans.skew import lookup_join

_NO_ID = -(1 << 63)
_PLACE_BITS = 24
_PART = 8  # windows of a part
_RANKS = "id bigint, h bigint, place bigint, n bigint, lead int, rank bigint, more bigint, later boolean"


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    least, span = values, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        step = width - span
        least = np.minimum(least[:-step], least[step:])
    return least


def _pieces(texts: Sequence[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, where the piece begins, bytes) lists; each window of a text is in one piece."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for begin in range(0, max(len(text) - length + 1, 0), W.SLICE):
            piece = text[begin : begin + W.SLICE + length - 1]
            if held and size + len(piece) > W.SLICE:
                yield held
                held, size = [], 0
            held.append((i, begin, piece))
            size += len(piece)
    if held:
        yield held


def _blocks(texts: Sequence[bytes], length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(text, place, windows, anchor's place in it, ranks of anchor and of all bytes) of every block."""
    out = []
    for held in _pieces(texts, length):
        data = np.frombuffer(b"".join(piece for _, _, piece in held), dtype=np.uint8)
        ends = np.cumsum([len(piece) for _, _, piece in held])
        begins = ends - [len(piece) for _, _, piece in held]
        sums = W.prefix_sums(data)
        _, down = W.powers(len(sums))
        count = len(data) - anchor + 1
        grams = W.mix((sums[anchor:] - sums[:-anchor]) * down[:count])
        low = np.uint64((1 << _PLACE_BITS) - 1)
        packed = (grams & ~low) | np.arange(count, dtype=np.uint64)
        owner = (_sliding_least(packed, length - anchor + 1) & low).astype(np.int64)
        piece = np.searchsorted(ends, np.arange(len(owner)), side="right")
        valid = np.arange(len(owner)) + length <= ends[piece]
        first = valid.copy()
        first[1:] &= (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1]) | ~valid[:-1]
        start = np.flatnonzero(first)
        last = valid.copy()
        last[:-1] &= first[1:] | ~valid[1:]
        end = np.flatnonzero(last)
        at = owner[start]
        span = W.span_hashes(sums, start, end + length)
        # The same bytes cut at other places around the anchor are another block.
        span = W.mix(span + (at - start).astype(np.uint64))
        which = piece[start]
        text = np.array([i for i, _, _ in held], dtype=np.int64)[which]
        shift = (np.array([begin for _, begin, _ in held], dtype=np.int64) - begins)[which]
        out.append((text, start + shift, end - start + 1, at - start, grams[at], span))
    return _columns(out)


def _columns(out: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    if not out:
        return tuple(np.zeros(0, dtype=kind) for kind in (np.int64,) * 4 + (np.uint64,) * 2)
    return tuple(np.concatenate(column) for column in zip(*out))


def _runs_of(
    texts: Sequence[bytes], runs: pa.ListArray, length: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, where the slice begins, its running sums, place, n and lead of its runs), in order."""
    ends = runs.offsets.to_numpy() - runs.offsets[0].as_py()
    place, n, lead = (
        runs.flatten().field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("place", "n", "lead")
    )
    for i, text in enumerate(texts):
        own = slice(ends[i], ends[i + 1])
        order = np.argsort(place[own])
        own_place, own_n, own_lead = place[own][order], n[own][order], lead[own][order]
        for begin in range(0, len(text), W.SLICE):
            low, high = np.searchsorted(own_place, [begin, begin + W.SLICE])
            if low < high:
                far = int((own_place + own_n)[low:high].max()) + length
                sums = W.prefix_sums(np.frombuffer(text[begin:far], dtype=np.uint8))
                yield i, begin, sums, own_place[low:high], own_n[low:high], own_lead[low:high]


def _parts(texts: Sequence[bytes], blocks: pa.ListArray, length: int) -> tuple[np.ndarray, ...]:
    """The same of the parts of blocks; their lead is not needed any more."""
    out = []
    for i, begin, sums, place, n, lead in _runs_of(texts, blocks, length):
        anchor = place + lead
        low, high = (lead - n + 1) // _PART, lead // _PART
        count = high - low + 1
        block = np.repeat(np.arange(len(place)), count)
        part = high[block] - (np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count))
        first = anchor[block] - np.minimum(lead[block], part * _PART + _PART - 1)
        last = anchor[block] - np.maximum((lead - n + 1)[block], part * _PART)
        core = anchor[block] - part * _PART - begin
        rank = W.span_hashes(sums, core, core + length - _PART + 1)
        more = W.span_hashes(sums, first - begin, last - begin + length)
        rank, more = W.mix(rank + part.astype(np.uint64)), W.mix(more + (anchor[block] - first).astype(np.uint64))
        out.append((np.full(len(first), i), first, last - first + 1, np.zeros_like(first), rank, more))
    return _columns(out)


def _windows(texts: Sequence[bytes], parts: pa.ListArray, length: int) -> tuple[np.ndarray, ...]:
    """The same of the windows of parts, by the ranks of their halves."""
    half = length // 2
    out = []
    for i, begin, sums, place, n, _ in _runs_of(texts, parts, length):
        at = np.repeat(place, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        near = at - begin
        one, two = W.span_hashes(sums, near, near + half), W.span_hashes(sums, near + half, near + length)
        out.append((np.full(len(at), i), at, np.ones_like(at), np.zeros_like(at), one, two))
    return _columns(out)


def _ranked(ids: np.ndarray, hashes: np.ndarray, found: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    """Rows to be ranked by Spark, one for each pair; runs of others are ``later`` at once.

    ``found`` is in ascending order of document and place.
    """
    text, place, n, lead, rank, more = found
    joined = W.mix(rank + W.mix(more))
    order = np.argsort(joined, kind="stable")
    first = np.ones(len(order), dtype=bool)
    first[1:] = joined[order][1:] != joined[order][:-1]
    later = np.zeros(len(order), dtype=bool)
    later[order[~first]] = True
    keep = np.flatnonzero(~later)
    drop = np.flatnonzero(later)
    # Later ones that follow each other are one row.
    begins = np.ones(len(drop), dtype=bool)
    begins[1:] = (text[drop][1:] != text[drop][:-1]) | (place[drop][1:] != (place + n)[drop][:-1])
    head = drop[begins]
    group = np.cumsum(begins) - 1
    lengths = np.bincount(group, weights=n[drop], minlength=len(head)).astype(np.int64)
    spread = W.mix(ids[text[head]].view(np.uint64) + W.mix(place[head].astype(np.uint64)))
    rows = np.concatenate([keep, head])
    columns = [
        ids[text[rows]],
        hashes[text[rows]],
        place[rows],
        np.concatenate([n[keep], lengths]),
        lead[rows].astype(np.int32),
        np.concatenate([rank[keep], spread]).view(np.int64),
        np.concatenate([more[keep], spread]).view(np.int64),
        np.repeat([False, True], [len(keep), len(head)]),
    ]
    for begin in range(0, len(rows), 50_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(column[begin : begin + 50_000]) for column in columns],
            ["id", "h", "place", "n", "lead", "rank", "more", "later"],
        )


def _in_order(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a batch by document, each document once; ids and hashes in that order."""
    ids, hashes = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("id", "h"))
    order = np.lexsort((hashes, ids))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    order = order[new]
    return order, ids[order], hashes[order]


def _rank_blocks(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        order, ids, hashes = _in_order(batch)
        column = batch.column("text").cast(pa.binary())
        texts = [column[i].as_py() for i in order.tolist()]
        yield from _ranked(ids, hashes, _blocks(texts, length, anchor))


def _rank_runs(
    batches: Iterator[pa.RecordBatch], cut: Callable[..., tuple[np.ndarray, ...]], length: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        order, ids, hashes = _in_order(batch)
        column, runs = batch.column("text").cast(pa.binary()), batch.column("runs")
        for begin in range(0, len(order), 1000):
            some = slice(begin, begin + 1000)
            texts = [column[i].as_py() for i in order[some].tolist()]
            found = cut(texts, runs.take(pa.array(order[some])), length)
            yield from _ranked(ids[some], hashes[some], found)


def _removed(batches: Iterator[pa.RecordBatch], length: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
    for batch in batches:
        column = batch.column("text").cast(pa.binary())
        rows = []
        for i in range(batch.num_rows):
            text, spans = column[i].as_py(), batch.column("spans")[i].as_py()
            kept, removed, runs = text, 0, 0
            if spans:
                parts, end = [], 0
                reach = -1  # up to where bytes are removed
                for span in sorted(spans, key=lambda span: span["place"]):
                    begin, stop = span["place"], span["place"] + span["n"] - 1 + length
                    if begin > reach:
                        parts.append(text[end:begin])
                        runs += 1
                        removed += stop - begin
                        reach = end = stop
                    elif stop > reach:
                        removed += stop - reach
                        reach = end = stop
                kept = b"".join([*parts, text[end:]])
            row = (batch.column("doc_id")[i].as_py(), len(text), removed, runs, hashlib.sha256(kept).hexdigest())
            rows.append(row + ((kept,) if with_text else ()))
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)] if rows else [pa.array([], kind) for kind in types]
        yield pa.RecordBatch.from_arrays(columns, names)


def _by_document(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """The runs of each document, each once: rows that repeat id and text give the same in every batch."""
    return rows.groupBy("id", "h").agg(F.collect_set(F.struct(*columns)).alias(name))


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 100,
    anchor: int = 24,
    with_text: bool = False,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, and its ``kept`` bytes if asked.

    ``n_spans`` counts the longest runs of removed bytes. A null or empty text has no bytes, and one
    shorter than ``length`` stays whole. Documents without an id come first, those of one id in the
    order of a hash of the text; rows that repeat id and text are one document and fare alike. Matches
    never cross documents and are judged on the input. An empty table gives no rows.
    """
    rows = keyed(docs, doc_id, text).select(
        "doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), F.col("_h").alias("h"), "text"
    )
    ranked = rows.select("id", "h", "text").mapInArrow(
        lambda batches: _rank_blocks(batches, length, anchor), _RANKS
    )
    blocks = written(_reranked(ranked, True), "repeat-blocks")

    # Below, texts are dealt by document once: every join reads the same shuffle of the same columns.
    def next_round(runs: DataFrame, cut: Callable[..., tuple[np.ndarray, ...]], last: bool) -> DataFrame:
        open_ = _by_document(runs.where("NOT later"), "runs", "place", "n", "lead")
        dealt = rows.join(open_, ["id", "h"]).select("doc_id", "id", "h", "text", "runs")
        ranked = dealt.mapInArrow(lambda batches: _rank_runs(batches, cut, length), _RANKS)
        return _reranked(ranked, not last)

    parts = next_round(blocks, _parts, False)
    windows = next_round(parts, _windows, True)
    later = [found.where("later").select("id", "h", "place", "n") for found in (blocks, parts, windows)]
    spans = _by_document(later[0].unionByName(later[1]).unionByName(later[2]), "spans", "place", "n")
    all_ = rows.join(spans, ["id", "h"], "left").select("doc_id", "id", "h", "text", "spans")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema += ", kept binary" if with_text else ""
    return all_.mapInArrow(lambda batches: _removed(batches, length, with_text), schema)


def _reranked(ranked: DataFrame, goes_on: bool) -> DataFrame:
    """Runs that are ``later``, their pair standing earlier too, and those that go to the next round.

    The latter are the first of their pair, with a first rank that has other pairs. A pair has a row
    for each batch of documents that holds it. A rank may stand in as many pairs as there are
    places: it is counted, with a partial result in every task, and looked up in a way that spreads
    the runs of frequent ranks. Rows that repeat id and text count each, so their runs go on; that
    finds nothing more.
    """
    pair = Window.partitionBy("rank", "more").orderBy("id", "h", "place")
    least = F.first(F.struct("id", "h", "place")).over(pair)
    ranked = ranked.withColumn("later", F.col("later") | (F.struct("id", "h", "place") != least))
    columns = ["id", "h", "place", "n", "lead", "later"]
    if not goes_on:
        return ranked.where("later").select(*columns)
    ranked = written(ranked.select(*columns, "rank"), "repeat-pairs")
    first = ranked.where("NOT later")
    counts = first.groupBy("rank").agg(F.count(F.lit(1)).alias("pairs"))
    others = written(counts.where("pairs > 1").select("rank"), "repeat-ranks")
    open_ = lookup_join(maybe_among(first, others, "rank"), others, "rank", ["id", "place"], "left_semi")
    return ranked.where("later").select(*columns).unionByName(open_.select(*columns))
