"""A linear classifier over averaged subword vectors, trained by stochastic gradient descent.

A word is a run of other bytes than white space. Its features are itself and its character n-grams,
which know whether they begin or end the word; all are hashed into one table of vectors. A document
is the mean of the vectors of all features of all its words, and a softmax over two classes reads
it. Vectors and output weights are learned together, one document a step, at a rate that falls
linearly. An unseen spelling of a known word still shares most of its n-grams.

Scoring needs one number per table row, the vector times the difference of the output weights, so a
model is a small array however wide the vectors are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger.llm import words as W
from jobledger.llm.tables import KEY, id_and_text, keyed

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0, 9, 10, 11, 12, 13, 32]] = True
_BEGINS, _ENDS, _WHOLE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Settings:
    """``sample`` labelled documents are learned from, at most, and ``sample_bytes`` bytes of text in all."""

    lower: bool = True
    bigrams: bool = False  # pairs of words as features too, and one row for a word that repeats the last
    shortest: int = 3
    longest: int = 5
    buckets: int = 1 << 18
    width: int = 8
    steps: int = 24_000  # documents seen in training, again and again where there are fewer
    rate: float = 20.0
    sample: int = 6000
    sample_bytes: int = 16_000_000
    seed: int = 7


#: Quality shows in capitals, punctuation and repeats, toxicity in words of any case.
QUALITY = Settings(lower=False, bigrams=True, sample=4000, steps=24_000)
TOXICITY = Settings(lower=True, sample=8000, steps=48_000)


@dataclass(frozen=True)
class Model:
    settings: Settings
    weights: np.ndarray  # one per table row
    bias: float


def _features(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, settings: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """(table row of every feature of the given words, word it belongs to)."""
    sums = W.prefix_sums(data)
    rows = [W.span_hashes(sums, starts, ends) ^ _WHOLE]
    owners = [np.arange(len(starts))]
    is_char = (data & 0xC0) != 0x80  # not a later byte of a character
    chars = np.flatnonzero(is_char)
    rank = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(is_char, out=rank[1:])
    chars = np.append(chars, len(data))
    first, last = rank[starts], rank[ends]  # characters of the word
    for n in range(settings.shortest, settings.longest + 1):
        count = np.maximum(last - first - n + 1, 0)
        owner = np.repeat(np.arange(len(starts)), count)
        at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        begin, end = chars[at], chars[at + n]
        hashed = W.span_hashes(sums, begin, end)
        hashed = np.where(begin == starts[owner], hashed ^ _BEGINS, hashed)
        rows.append(np.where(end == ends[owner], hashed ^ _ENDS, hashed))
        owners.append(owner)
    rows_ = W.mix(np.concatenate(rows)) % np.uint64(settings.buckets - 1) + np.uint64(1)
    return rows_.astype(np.int64), np.concatenate(owners)


def _words(pieces: Sequence[bytes], settings: Settings) -> tuple[np.ndarray, ...]:
    """(bytes, starts and ends of the distinct words; hash, distinct word and piece of every word)."""
    data = np.frombuffer(b"\0".join(pieces), dtype=np.uint8)
    if settings.lower:
        data = W._LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hashed = W.span_hashes(W.prefix_sums(data), starts, ends)
    _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
    limits = np.cumsum([len(piece) + 1 for piece in pieces])
    piece = np.searchsorted(limits, starts, side="right")
    return data, starts[first], ends[first], hashed, which, piece


def _pairs(hashed: np.ndarray, piece: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(table row, place of its second word) of every pair of words that follow each other."""
    at = np.flatnonzero(piece[1:] == piece[:-1]) + 1
    first, second = hashed[at - 1], hashed[at]
    rows = W.mix(first * _BEGINS + second) % np.uint64(settings.buckets - 1) + np.uint64(1)
    return np.where(first == second, 0, rows.astype(np.int64)), at


def scores(texts: Sequence[bytes], model: Model) -> np.ndarray:
    """The probability of class 1; a text without words has that of the bias alone."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for index, pieces in W.slices(texts):
        data, starts, ends, hashed, which, piece = _words(pieces, model.settings)
        rows, owner = _features(data, starts, ends, model.settings)
        value = np.bincount(owner, weights=model.weights[rows], minlength=len(starts))[which]
        features = np.bincount(owner, minlength=len(starts))[which].astype(np.float64)
        if model.settings.bigrams:
            rows, at = _pairs(hashed, piece, model.settings)
            value[at] += model.weights[rows]
            features[at] += 1
        text = np.asarray(index, dtype=np.int64)[piece]
        total += np.bincount(text, weights=value, minlength=len(texts))
        count += np.bincount(text, weights=features, minlength=len(texts))
    logits = np.divide(total, count, out=np.zeros(len(texts)), where=count > 0) + model.bias
    return 1.0 / (1.0 + np.exp(-np.clip(logits, -500, 500)))


def bags(texts: Sequence[bytes], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(table rows, share of the features) of each text."""
    for text in texts:
        data, starts, ends, hashed, which, piece = _words([text], settings)
        rows, owner = _features(data, starts, ends, settings)
        often = np.bincount(which, minlength=len(starts))[owner]
        if settings.bigrams:
            pairs, _ = _pairs(hashed, piece, settings)
            rows, often = np.append(rows, pairs), np.append(often, np.ones(len(pairs)))
        found, place = np.unique(rows, return_inverse=True)
        count = np.bincount(place, weights=often, minlength=len(found))
        yield found.astype(np.int32), (count / max(count.sum(), 1)).astype(np.float32)


def train(texts: Sequence[bytes], labels: Sequence[int], settings: Settings) -> Model:
    """Without labels every score is 0.5; with one class only, its share once smoothed."""
    labels = np.asarray(labels, dtype=np.int64)
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (settings.buckets, settings.width)).astype(np.float32) / settings.width
    output = np.zeros((settings.width, 2), dtype=np.float32)
    shares = (np.bincount(labels, minlength=2) + 1.0) / (len(labels) + 2.0)
    bias = np.log(shares).astype(np.float32)
    learned = list(bags(texts, settings))
    step = 0
    while len(labels) and step < settings.steps:
        for i in random.permutation(len(labels))[: settings.steps - step]:
            rate = settings.rate * (1.0 - step / settings.steps)
            step += 1
            rows, share = learned[i]
            there = vectors[rows]
            mean = share @ there
            logits = mean @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[i]] -= 1.0
            back = output @ error
            # The output sees a whole document, a vector only its share of one: their steps differ.
            output -= np.float32(0.01 * rate) * np.outer(mean, error)
            bias -= np.float32(0.001 * rate) * error
            vectors[rows] = there - np.float32(rate) * np.outer(share, back)
    weights = vectors @ (output[:, 1] - output[:, 0])
    return Model(settings, weights, float(bias[1] - bias[0]))


def labelled(docs: DataFrame, labels: DataFrame, label: str, settings: Settings) -> tuple[list[bytes], list[int]]:
    """The sample to learn from: the labelled documents whose ids hash lowest.

    The sample is chosen by ids and sizes alone; only the texts of the chosen documents, no more than
    ``sample``, leave the scan. Of these, in that order, each is taken that fits into what is left of
    ``sample_bytes``, long ones like others. Labels other than 0 and 1, documents without an id and
    empty texts are left out; rows that repeat id, text and label count once.
    """
    keys = keyed(docs)
    sized = keys.select(*KEY, F.octet_length("text").alias("_size")).where("_size > 0")
    labels = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("_label"))
    chosen = sized.join(labels.where(F.col("_label").isin(0, 1)), "doc_id").distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "_h", "_label").limit(settings.sample).collect()
    left, taken = settings.sample_bytes, []
    for row in chosen:
        if row["_size"] <= left:
            left -= row["_size"]
            taken.append((row["doc_id"], row["_h"], row["_label"]))
    schema = "doc_id bigint, _h bigint, _label int"
    chosen = F.broadcast(docs.sparkSession.createDataFrame(taken, schema))  # at most ``sample`` short rows
    found = keys.join(chosen, list(KEY)).groupBy(*KEY, "_label").agg(F.any_value("text").alias("text"))
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "_h", "_label").collect()
    return [row["text"].encode() for row in found], [row["_label"] for row in found]


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.short(batches):
            found = scores(W.text_bytes(batch.column("text")), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, score double")


def score_of(text: str, model: Model) -> Column:
    """The score as a column, next to whatever other columns there are."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        parts = W.short(iter([pa.record_batch([texts], ["text"])]))
        found = [scores(W.text_bytes(part.column("text")), model) for part in parts]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return run(F.coalesce(F.col(text), F.lit("")))


def drop_scored(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    return docs.where(score_of(text, model) < threshold)


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a missing id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(divisor))
