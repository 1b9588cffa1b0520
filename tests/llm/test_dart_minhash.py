"""Near-duplicates against all pairs."""

import collections
import random
import re

import numpy as np
import pytest
from conftest import ODD

from jobledger.llm import dart_minhash as dart
from jobledger.llm import words as W
from jobledger.llm.components import components

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_words_equal_the_pattern(prose, monkeypatch):
    texts = [t.encode() for t in ("", "..", "Ab-cD 12é", "日本 x", prose(200, 1), "a" * 300, "x " * 80)]
    expected = [WORD.findall(t.lower()) for t in texts]
    for size in (1 << 21, 40):
        monkeypatch.setattr(W, "SLICE", size)
        hashes, offsets = W.hashed_words(texts)
        assert list(np.diff(offsets)) == [len(e) for e in expected]
        names = {}
        for word, value in zip((w for e in expected for w in e), hashes.tolist()):
            assert names.setdefault(word, value) == value
        assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("size", [1, 3, 5])
def test_shingles(size):
    texts = [b"a b c d e f", b"", b"a b", b"c d e", b"a b c d e f"]
    words, offsets = W.hashed_words(texts)
    found, ends = W.shingles(words, offsets, size)
    assert list(np.diff(ends)) == [max(n - size + 1, min(n, 1)) for n in np.diff(offsets)]
    assert list(found[ends[0] : ends[1]]) == list(found[ends[4] : ends[5]])


def test_agreement_is_the_weighted_similarity():
    random_ = np.random.default_rng(5)
    names = W.mix(np.arange(1, 80).astype(np.uint64))
    one, two = random_.integers(0, 6, 79).astype(float), random_.integers(0, 6, 79).astype(float)
    one[3] += 0.5
    text = np.concatenate([np.zeros((one > 0).sum(), int), np.ones((two > 0).sum(), int)])
    element = np.concatenate([names[one > 0], names[two > 0]])
    weight = np.concatenate([one[one > 0], two[two > 0]])
    signed = dart.signatures(text, element, weight, 2, 6000)
    similarity = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert abs((signed[0] == signed[1]).mean() - similarity) < 0.03


def test_every_coordinate_is_filled():
    signed = dart.signatures(np.array([1]), np.array([9], dtype=np.uint64), np.array([1.0]), 3, 128)
    assert (signed[1] != 0).all() and (signed[[0, 2]] == 0).all()


def bag(text):
    words = WORD.findall((text or "").lower().encode())
    runs = [tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))]
    return tuple(words), collections.Counter(runs)


def classes(rows):
    """Class of every key by comparing all pairs."""
    keys = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    bags = [bag(text) for _, text in keys]
    group = list(range(len(keys)))
    for i in range(len(keys)):
        for j in range(i):
            both = sum((bags[i][1] & bags[j][1]).values())
            either = sum((bags[i][1] | bags[j][1]).values())
            if either and (bags[i][0] == bags[j][0] or both >= 0.8 * either - 1e-9):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return {frozenset(keys[i] for i in range(len(keys)) if group[i] == g) for g in set(group)}


def edited(text, edits, seed):
    random_ = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[random_.randrange(len(words))] = f"e{random_.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture
def near(prose):
    rows = [r for r in ODD if r[1] is not None]
    at = 100
    for base in range(6):
        text = prose(150, base)
        for copy in range(25):
            rows.append((at, edited(text, [0, 1, 2, 3, 5, 8][copy % 6], at)))
            at += 1
    rows += [(at + i, prose(60, 1000 + i)) for i in range(40)]
    rows += [(at + 100 + i, " ".join(["same"] * (20 + i))) for i in range(12)]
    return rows


@pytest.mark.parametrize("block", [256, 7])
def test_classes_equal_all_pairs(spark, docs, near, block, monkeypatch):
    monkeypatch.setattr(dart, "BLOCK", block)
    found = dart.near_duplicates(docs(near)).collect()
    text_of = {}
    for row in spark.createDataFrame(near, "doc_id long, text string").selectExpr("*", "xxhash64(text) h").collect():
        text_of[row.doc_id, row.h] = row.text
    groups = collections.defaultdict(set)
    for row in found:
        groups[row.class_id, row.class_h].add((row.doc_id, text_of[row.doc_id, row._h]))
    assert {frozenset(g) for g in groups.values()} == classes(near)
    assert sum(row.n_rows for row in found) == len(near)


def test_one_of_each_class_stays(docs, near):
    df = docs(near)
    kept = dart.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len(classes(near))
    assert kept.where("doc_id = 7").count() == 1


def test_nulls_and_nothing(docs):
    assert dart.near_duplicates(docs(ODD).limit(0)).collect() == []
    assert dart.keep_one(docs(ODD).limit(0)).collect() == []
    found = dart.keep_one(docs([(1, None), (2, ""), (None, None), (3, "a b"), (4, "A, b!")]))
    assert sorted(str(r.doc_id) for r in found.collect()) == ["1", "2", "3", "None"]


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 200)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(df.limit(0)).collect() == []


def test_components_of_shuffled_numbers(spark):
    """Nodes that have two roots when no root is below another: the links must not be cut there."""
    df = spark.createDataFrame([(4, 1), (4, 3), (5, 3), (5, 2)], "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == {n: 1 for n in range(1, 6)}
    random_ = random.Random(7)
    links, expected, base = [], {}, 0
    for size in [5, 6, 8, 10, 30] * 12:
        numbers = random_.sample(range(base, base + size), size)
        path = random_.random() < 0.5
        links += [(numbers[i], numbers[i - 1 if path else random_.randrange(i)]) for i in range(1, size)]
        expected |= {n: base for n in numbers}
        base += size
    random_.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == expected
