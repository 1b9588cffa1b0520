"""License rules, string tiling and subword scores against plain Python."""

import re
import tracemalloc

import numpy as np
import pytest
from conftest import ODD

from jobledger.llm import license_scan, string_tiling, subwords
from jobledger.llm import words as W

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def by_hand(text, table):
    """The scan of one text with the standard library's expressions."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    spaced = "".join(f" {word} " for word in words)
    found = []
    for number, rule in enumerate(table):
        if rule.gate in spaced:
            for match in re.finditer(rule.pattern, spaced):
                first = spaced[: match.start()].count(" ") // 2
                found.append((rule.priority, first, first + match[0].count(" ") // 2, number, rule.label))
    base = [d for d in found if d[0] == 0]
    kept = list(base)
    for own in found:
        if own[0] and not any(
            o is not own and o[0] and o[1] <= own[1] and own[2] <= o[2]
            and (o[0] < own[0] or (o[0] == own[0] and (o[1], -o[2], o[3]) < (own[1], -own[2], own[3])))
            for o in found
        ):
            kept.append(own)
    return (
        len(words),
        len(base),
        min((d[1] for d in base), default=None),
        max((d[1] for d in base), default=None),
        ",".join(sorted({d[4] for d in base})),
        ",".join(sorted({d[4] for d in kept})),
        max((license_scan.CONFIDENCE[d[0]] for d in kept), default=0.0),
    )


TEXTS = [
    "This work is licensed under the GNU General Public License, version 2 or (at your option) any later version.",
    "CC-BY 4.0; cc by cc-by, ccby. Creative Commons Attribution\nCC BY-SA",
    "Copyright (c) 2020 Acme Inc. All rights reserved. ALL RIGHTS  RESERVED",
    "general public licence is not the general public license",
    "MIT License. SPDX-License-Identifier: MIT", "Redistribution and use in source and binary forms",
    "under the terms of the Apache License 2.0 and the Mozilla Public License", "généralpublic license Ä all rights reservedé",
    "a license agreement " * 300 + "general public license " * 200, "", None, "...", "no hit here",
]


def test_rules_are_many_and_valid():
    table = license_scan.rules()
    assert len(table) > 200
    assert len({rule.label for rule in table}) == len(table)
    for rule in table:
        re.compile(rule.pattern)


def matched(words):
    """Words that a rule's pattern matches, without the optional ones."""
    required = [word for word in words.split() if not word.endswith("?")]
    first = [re.sub(r"\(([^|()]*)\|[^()]*\)", r"\1", word).replace("\\S+", "x") for word in required]
    return "".join(f" {re.sub(r'\[(.).*?\]\+?', r'\1', word)} " for word in first)


def test_signatures_match_their_own_words_and_have_their_keyword():
    for rule in license_scan.rules():
        assert re.fullmatch(rule.pattern, matched(rule.words)), rule
        assert rule.gate in matched(rule.words), rule
        assert any(anchor in rule.gate for anchor in license_scan.ANCHORS), rule


@pytest.mark.parametrize(
    "text,label",
    [
        ("Licensed under the Apache License, Version 2.0 (the \"License\");", "apache:under"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit:grant"),
        ("SPDX-License-Identifier: MIT", "spdx:identifier"),
        ("released under the BSD 3-Clause License", "bsd:clause-after"),
        ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "bsd:file"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc:work"),
        ("You should have received a copy of the GNU General Public License", "gpl:received"),
        ("licensed under an MIT license", "mit:under"),
    ],
)
def test_common_notices(docs, text, label):
    (found,) = license_scan.license_scan(docs([(1, text)])).collect()
    assert label in found.labels.split(",")


def test_scan_equals_the_standard_library(docs):
    table = license_scan.rules()
    rows = [*enumerate(TEXTS), (None, TEXTS[0]), (3, TEXTS[1]), (3, TEXTS[1])]
    found = license_scan.license_scan(docs(rows)).collect()
    expected = [(i, *by_hand(text, table)) for i, text in rows]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert license_scan.license_scan(docs(rows).limit(0)).collect() == []


def tokens(text):
    return W.hashed_words([text.encode()])[0]


@pytest.mark.parametrize(
    "item,text,tiles",
    [
        ("a b c d e f", "x a b c d e f y", [(6, 0, 1)]),
        ("a b c d e f", "d e f q a b c", [(3, 0, 4), (3, 3, 0)]),
        ("a b c a b c", "a b c", [(3, 0, 0)]),
        ("a a a a a a", "a a a", [(3, 0, 0)]),
        ("a b c d", "a b", []),
        ("a b c d e f g", "a b c d z c d e f g", [(5, 2, 5)]),
    ],
)
def test_tiles(item, text, tiles):
    for start in (20, 4, 3):
        found = string_tiling.tiles(tokens(item), tokens(text), 3, start)
        assert sorted((n, i, j) for n, i, j in found) == sorted(tiles)


def greedy(item, text, least):
    """Coverage by marking the longest match again and again."""
    a, b = list(item), list(text)
    covered = 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] is not None and a[i + n] == b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return covered
        covered += n
        a[i : i + n] = [None] * n
        b[j : j + n] = [object()] * n


def test_tiling_covers_as_much_as_the_greedy_loop():
    random_ = np.random.default_rng(3)
    for _ in range(60):
        item = [int(x) for x in random_.integers(0, 4, random_.integers(3, 30))]
        text = [int(x) for x in random_.integers(0, 4, random_.integers(3, 40))]
        made = string_tiling.tiles(np.array(item, dtype=np.uint64), np.array(text, dtype=np.uint64), 3)
        # Ties between equally long matches may fall differently.
        assert abs(sum(n for n, _, _ in made) - greedy(item, text, 3)) <= 3
        assert all(item[i : i + n] == text[j : j + n] for n, i, j in made)
        marks = [k for n, i, _ in made for k in range(i, i + n)]
        assert len(marks) == len(set(marks))


@pytest.mark.parametrize("hot", [10_000, 0])
def test_contaminated(spark, docs, prose, monkeypatch, hot):
    monkeypatch.setattr(string_tiling, "HOT_ITEMS", hot)
    monkeypatch.setattr(string_tiling, "HOT_WORDS", hot)
    items = {0: prose(40, 1), 1: prose(30, 2), 2: "short one", 3: None, 4: "", 5: prose(12, 3)}
    words = items[0].split()
    reordered = " ".join(words[20:] + ["q"] + words[:20])
    rows = [
        *ODD, (30, prose(50, 9) + " " + items[0]), (31, reordered.upper()), (32, " ".join(words[:15])),
        (33, "a Short, one b"), (34, prose(500, 10)), (35, items[5] + " " + items[1]), (None, items[1]),
        (36, "\n".join(words)),
    ]
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    df = docs(rows)
    found = string_tiling.contaminated(df, benchmark).collect()
    pairs = {(30, 0), (31, 0), (33, 2), (35, 5), (35, 1), (None, 1), (36, 0)}
    assert {(r.doc_id, r.item_id) for r in found} == pairs and len(found) == len(pairs)
    for row in found:
        text = next(t for i, t in rows if i == row.doc_id and (i is not None or t == items[1]))
        said, meant = WORD.findall(text.lower()), WORD.findall(items[row.item_id].lower())
        assert sum(t.words for t in row.tiles) == pytest.approx(row.coverage * len(meant))
        for t in row.tiles:
            assert said[t.doc_word : t.doc_word + t.words] == meant[t.item_word : t.item_word + t.words]
    kept = string_tiling.decontaminated(df, benchmark)
    assert kept.columns == df.columns and kept.count() == len(rows) - 6
    assert string_tiling.contaminated(df, benchmark.limit(0)).collect() == []
    assert string_tiling.contaminated(df.limit(0), benchmark).collect() == []


def test_pairs_of_frequent_phrases_equal_all_pairs(spark, docs):
    random_ = np.random.default_rng(5)
    say = lambda n: " ".join(f"v{x}" for x in random_.integers(0, 3, n))
    items = {i: "of the following which one " + say(int(random_.integers(0, 14))) for i in range(25)}
    rows = [(i, say(int(random_.integers(1, 60))) + " of the following which one " + say(20)) for i in range(60)]
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    expected = {}
    for doc_id, text in rows:
        for item_id, item in items.items():
            pattern = tokens(item)
            made = string_tiling.tiles(pattern, tokens(text), min(5, len(pattern)))
            if sum(n for n, _, _ in made) >= 0.5 * len(pattern):
                expected[doc_id, item_id] = sum(n for n, _, _ in made) / len(pattern)
    found = string_tiling.contaminated(docs(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id): r.coverage for r in found} == expected
    assert 60 < len(found) == len(expected) < 60 * 25


def test_a_last_document_that_is_a_short_item(spark, docs, prose):
    benchmark = spark.createDataFrame([(0, prose(40, 1)), (2, "short one")], "item_id long, text string")
    rows = [(1, prose(30, 4)), (2, "Short one")]
    found = string_tiling.contaminated(docs(rows, partitions=1), benchmark).collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in found] == [(2, 2, 1.0)]
    assert [tuple(t) for t in found[0].tiles] == [(0, 0, 2)]
    found = string_tiling.contaminated(docs([(2, "short one")], partitions=1), benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(2, 2)]


def features_by_hand(word, settings):
    """Character n-grams of a word with marks at its ends."""
    grams = [("word", word)]
    for n in range(settings.shortest, settings.longest + 1):
        for i in range(len(word) - n + 1):
            grams.append((i == 0, i + n == len(word), word[i : i + n]))
    return grams


def test_features_are_words_and_character_grams():
    settings = subwords.Settings(buckets=1 << 40)
    seen = {}
    for word in ("naïve", "naïf", "日本語です", "a", "idiot", "idiots"):
        data, starts, ends, *_ = subwords._words([word.encode()], settings)
        rows, _ = subwords._features(data, starts, ends, settings)
        grams = features_by_hand(word, settings)
        assert len(rows) == len(grams)
        for gram, row in zip(grams, rows.tolist()):
            assert seen.setdefault(gram, row) == row
    assert len(set(seen.values())) == len(seen)


def test_scores_equal_the_trained_mean(prose):
    settings = subwords.Settings(bigrams=True, sample=50, steps=500, buckets=1 << 12)
    texts = [f"{prose(20, i)} {'vile words' if i % 2 else 'kind words'}".encode() for i in range(50)]
    model = subwords.train(texts, [i % 2 for i in range(50)], settings)
    for text, score in zip(texts, subwords.scores(texts, model)):
        ((rows, share),) = subwords.bags([text], settings)
        logit = float(share @ model.weights[rows]) + model.bias
        assert score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4)


def test_scores_hold_the_features_of_few_texts_at_a_time(prose):
    model = subwords.train([], [], subwords.Settings(steps=10))
    texts = [f"{prose(300, i)} {'long ' * 60_000 if i == 7 else ''}".encode() for i in range(600)]
    alone = [subwords.scores([text], model)[0] for text in texts]
    tracemalloc.start()
    together = subwords.scores(texts, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert together.tolist() == alone
    assert peak < 30 * W.SLICE


def test_unseen_spellings_score_high(docs, prose):
    texts = [f"{prose(25, i)} {'horrible' if i % 3 == 0 else ''} {prose(10, i + 500)}" for i in range(400)]
    settings = subwords.Settings(steps=6000, buckets=1 << 14)
    model = subwords.train([t.encode() for t in texts], [int(i % 3 == 0) for i in range(400)], settings)
    fresh = [f"{prose(35, 9000 + i)} {'horribble' if i % 2 else ''}" for i in range(100)]
    score = subwords.scores([t.encode() for t in fresh], model)
    assert score[1::2].mean() > score[::2].mean() + 0.2
    df = docs([*ODD, *enumerate(fresh, 100)])
    found = {r.doc_id: r.score for r in subwords.scored(df, model).where("doc_id >= 100").collect()}
    assert [found[100 + i] for i in range(100)] == pytest.approx(score.tolist())
    assert subwords.scored(df, model).count() == df.count()
    kept = subwords.drop_scored(df, model, 0.5)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.score < 0.5 for r in subwords.scored(df, model).collect())
    assert subwords.scored(df.limit(0), model).collect() == []


def test_training_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    settings = subwords.Settings(steps=10)
    assert subwords.labelled(docs(ODD), labels, "toxic", settings) == ([], [])
    model = subwords.train([], [], settings)
    assert subwords.scores([b"", b"some words"], model).tolist() == [0.5, 0.5]


def test_sample_is_bounded_and_takes_each_document_once(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(7, 5), (None, 1)], "doc_id long, toxic int")
    texts, found = subwords.labelled(docs(ODD), labels, "toxic", subwords.Settings(sample=100))
    assert sorted(texts) == sorted(t.encode() for i, t in set(ODD) if i is not None and t)
    assert len(found) == len(texts)
    assert len(subwords.labelled(docs(ODD), labels, "toxic", subwords.Settings(sample=2))[0]) == 2
