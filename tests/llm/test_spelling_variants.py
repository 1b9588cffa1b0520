"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from jobledger.llm import spelling_variants as sv

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(rows, every=None):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            if every:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
                if h % every == 0:
                    word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += len(word) >= 5
    n = {word: count for word, count in n.items() if count >= 3}
    found = {}
    for word in n:
        others = sorted((o for o in n if near(word, o)), key=lambda o: (-n[o], o))
        form = others[0] if others and n[others[0]] >= 2 * n[word] else None
        found[word] = (form, n[word], len(others), n[form] if form else None)
    rows = []
    for word, (form, count, n_near, form_n) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        rows.append((word, form, root, count, n_near, form_n))
    return sorted(rows, key=str)


def found(docs, **how):
    return sorted((tuple(row) for row in sv.spelling_variants(docs, **how).collect()), key=str)


def test_against_all_pairs(docs):
    random_ = random.Random(3)
    base = ["".join(random_.choice("abcé") for _ in range(random_.randrange(4, 9))) for _ in range(40)]
    words = []
    for word in base:
        for _ in range(12):
            edited = list(word)
            kind, at = random_.randrange(4), random_.randrange(len(word))
            if kind == 1:
                del edited[at]
            elif kind == 2:
                edited.insert(at, edited[at])  # a doubled letter can be left out at two places
            elif kind == 3:
                edited[at] = random_.choice("abcéÿ")
            words += ["".join(edited)] * random_.choice((1, 3, 3, 5, 12))
    random_.shuffle(words)
    rows = [(i % 30, " ".join(words[i : i + 40])) for i in range(0, len(words), 40)]
    assert found(docs(rows)) == expected(rows) and any(row[1] for row in expected(rows))
    assert found(docs(rows), slip_every=7) == expected(rows, 7)


def test_ties_chains_case_and_letters(docs):
    rows = [(1, "hallo " * 4 + "hello " * 4 + "hillo " * 2 + "HILLO"), (2, "chain " * 20 + "chains " * 9 + "chainsx " * 3),
            (3, "Été1été2étés÷étés étés " + "éTÉS " * 3), (4, "aaaaaa " * 3 + "aaaaa " * 6)]
    assert found(docs(rows)) == expected(rows)


def test_odd_rows_and_long_words(docs):
    long = "xyz" * 60_000  # a run of letters as long as a text
    rows = [(None, "words without an id " * 3), (5, None), (6, ""), (7, "7 !"), (8, "again " * 3), (8, "again " * 3),
            (9, long), (10, long), (11, long), (12, long[1:]), (13, long[1:]), (14, long[1:] + " " + long)]
    rows = rows + [(1, "1 " * 10 + "words ")]
    got = {row[0]: row[1:] for row in found(docs(rows), slip_every=10**9)}
    assert got["again"][2] == 6 and got["words"][2] == 4
    assert got[long] == (None, long, 4, 1, None) and got[long[1:]][3] == 1
    assert found(docs([(1, None), (2, "tiny")])) == []
    assert found(docs(rows).limit(0)) == []


def test_ratio_below_two_is_refused(docs):
    with pytest.raises(ValueError):
        sv.spelling_variants(docs([(1, "x")]), ratio=1)


def test_pieces_of_a_text_end_between_runs(monkeypatch):
    monkeypatch.setattr(sv, "PIECE", 5)
    text = "One, tWo-Three  Été x" * 3
    pieces = [run for runs in sv._runs(text.encode()) for run in runs]
    assert pieces == re.findall("[A-Za-zÀ-ÿ]+", text.translate(LOWER))
