"""Hashed words of many texts at once, in numpy.

A word is a longest run of digits, letters a-z after lower-casing A-Z, and bytes of non-ASCII
characters. Texts are joined with a zero byte, cut into words by one pass over the bytes, and hashed
by a polynomial over the running sum of the bytes before them, so no word becomes a Python object.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

SLICE = 1 << 20  # a longer text is cut between words
TOGETHER = 1 << 18  # bytes of short texts handled at a time
_BASE = 0x2545F4914F6CDD1D
_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _IN_WORD[_first : _last + 1] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def _powers_of(base: int, bits: int) -> np.ndarray:
    powers = np.full(1 << bits, np.uint64(base), dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2**64."""
    bits = max(19 if count < 1 << 19 else 21, int(count).bit_length())
    return _powers_of(_BASE, bits)[:count], _powers_of(pow(_BASE, -1, 1 << 64), bits)[:count]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``sums[i]``: the polynomial over the first i bytes."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, wherever it stands."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def slices(texts: Sequence[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """(index of the text, piece) lists of up to TOGETHER bytes, or one piece of up to SLICE; longer
    texts are cut between words."""
    index: list[int] = []
    pieces: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text) or at == 0:
            end = min(len(text), at + SLICE)
            if end < len(text):  # go on to the end of the word that is cut
                while end < len(text) and _IN_WORD[_LOWER[text[end]]]:
                    end += 1
            if pieces and size + end - at > TOGETHER:
                yield index, pieces
                index, pieces, size = [], [], 0
            index.append(i)
            pieces.append(text[at:end] if at or end < len(text) else text)
            size += end - at + 1
            at = end
            if at >= len(text):
                break
    if pieces:
        yield index, pieces


def word_spans(pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes of all pieces, starts and ends of their words, piece of each word)."""
    data = _LOWER[np.frombuffer(b"\0".join(pieces), dtype=np.uint8)]
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = _IN_WORD[data]
    edges = np.diff(inside)
    starts = np.flatnonzero(edges == 1)
    ends = np.flatnonzero(edges == -1)
    limits = np.cumsum([len(piece) + 1 for piece in pieces])
    return data, starts, ends, np.searchsorted(limits, starts, side="right")


def hashed_words(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, offsets of the texts in it)."""
    hashes = []
    counts = np.zeros(len(texts) + 1, dtype=np.int64)
    for index, pieces in slices(texts):
        data, starts, ends, piece = word_spans(pieces)
        hashes.append(span_hashes(prefix_sums(data), starts, ends))
        np.add.at(counts, np.asarray(index, dtype=np.int64)[piece] + 1, 1)
    joined = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    return joined, np.cumsum(counts)


def shingles(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``size`` words, offsets of the texts in it).

    A text of fewer words, but one at least, is one shingle of all its words.
    """
    counts = np.diff(offsets)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(made)])
    text = np.repeat(np.arange(len(counts)), made)
    first = offsets[:-1][text] + np.arange(len(text)) - ends[:-1][text]
    width = np.minimum(counts, size)[text]
    total = width.astype(np.uint64)
    for step in range(size):
        there = step < width
        word = words[np.where(there, first + step, 0)] if len(words) else total
        total = np.where(there, total * np.uint64(0x9E3779B97F4A7C15) + word, total)
    total = mix(total)
    return total, ends


def parts(texts: Sequence[bytes], most: int = 1000) -> Iterator[tuple[int, int]]:
    """Ranges of up to ``most`` texts and TOGETHER bytes together."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and (size + len(text) > TOGETHER or i - first >= most):
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def short(batches: Iterator[pa.RecordBatch], rows: int = 100) -> Iterator[pa.RecordBatch]:
    """The batches cut to ``rows`` rows, so that few of their texts are Python objects at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes, a null as the empty text."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]
