"""Repeated byte strings and runs of lines against a set of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import ODD

from jobledger.llm import line_runs, suffix_dedup
from jobledger.llm import words as W


def ordered(rows):
    unique = set((i, t or "") for i, t in rows)
    return sorted(unique, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def marked(units, seen, least):
    marks = [False] * len(units)
    for at in range(len(units) - least + 1):
        window = tuple(units[at : at + least])
        if window in seen:
            marks[at : at + least] = [True] * least
        seen.add(window)
    return marks


def spans(marks):
    return sum(1 for i, m in enumerate(marks) if m and not (i and marks[i - 1]))


def bytes_by_hand(rows, least):
    seen, out = set(), {}
    for i, text in ordered(rows):
        data = text.encode()
        marks = marked(data, seen, least)
        kept = bytes(b for b, m in zip(data, marks) if not m)
        out[i, text] = (len(data), sum(marks), spans(marks), hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture
def tangled():
    """Texts of few characters, with passages cut and repeated in and across them."""
    random_ = random.Random(4)
    base = "".join(random_.choice("abé") for _ in range(500))
    rows = [(i, t) for i, t in ODD if i != 6 and i is not None]
    for i in range(90):
        kind = i % 6
        cut = random_.randrange(300)
        rows.append((100 + i, [
            "a" * random_.randrange(400),
            base[cut : cut + random_.randrange(90, 220)],
            "ab" * random_.randrange(150),
            f"x{i}" * 20 + base[100:250] + base[90:230],
            base[:150] + f"{i}" + base[150:300],
            base[cut : cut + 99],
        ][kind]))
    return rows


@pytest.mark.parametrize("slice_,length,anchor", [(1 << 21, 100, 24), (300, 100, 24), (1 << 21, 20, 8)])
def test_removed_bytes(docs, tangled, monkeypatch, slice_, length, anchor):
    expected = bytes_by_hand(tangled, length)
    with monkeypatch.context() as patch:
        patch.setattr(W, "SLICE", slice_)
        blocks = suffix_dedup._blocks([(t or "").encode() for _, t in tangled], length, anchor)
    # Every window is in one block, in order, whatever the slices.
    windows = [(int(t), int(p) + k) for t, p, n in zip(*blocks[:3]) for k in range(int(n))]
    wanted = [(i, p) for i, (_, t) in enumerate(tangled) for p in range(len((t or "").encode()) - length + 1)]
    assert windows == wanted
    found = suffix_dedup.remove_repeats(docs(tangled), length=length, anchor=anchor).collect()
    by_id = {i: value for (i, _), value in expected.items()}
    assert len(found) == len(tangled)
    assert [tuple(r)[1:] for r in found] == [by_id[r.doc_id] for r in found]


def test_ids_missing_and_shared(docs):
    rows = [(None, "a" * 300), (None, "b" * 300), (1, None), (1, "a" * 150), (1, "a" * 150), (2, "b" * 100)]
    found = suffix_dedup.remove_repeats(docs(rows), with_text=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.kept)) for r in found) == [
        ("1", 0, 0, 0), ("1", 150, 150, 0), ("1", 150, 150, 0), ("2", 100, 100, 0), ("None", 300, 299, 1),
        ("None", 300, 299, 1),
    ]
    assert suffix_dedup.remove_repeats(docs(rows).limit(0)).collect() == []


def test_repeated_rows_over_partitions(docs):
    """The first occurrence stays where rows that repeat it fall into several batches."""
    random_ = random.Random(8)
    one, two, three = ("".join(random_.choice("abcdefgh") for _ in range(400)) for _ in range(3))
    rows = [(1, one)] * 6 + [(2, two[:200] + one[150:300] + two[200:]), (3, three[:90] + one[170:330] + three[90:])]
    expected = {i: value for (i, _), value in bytes_by_hand(rows, 100).items()}
    found = suffix_dedup.remove_repeats(docs(rows)).collect()
    assert len(found) == len(rows) and expected[1][1] == 0
    assert [tuple(r)[1:] for r in found] == [expected[r.doc_id] for r in found]


def test_sliding_least():
    values = np.random.default_rng(1).integers(0, 9, 60).astype(np.uint64)
    for width in (1, 2, 3, 7, 8, 13, 60):
        expected = [min(values[i : i + width]) for i in range(60 - width + 1)]
        assert list(suffix_dedup._sliding_least(values, width)) == expected


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_removed_lines(docs, least):
    random_ = random.Random(least)
    rows = [(i, "\n".join(random_.choice("aab") for _ in range(random_.randrange(14)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "a\n\nb\n"), (202, "a\n\nb\n")]
    seen, expected = set(), {}
    for i, text in ordered(rows):
        lines = text.split("\n")
        marks = marked(lines, seen, least)
        kept = "\n".join(line for line, m in zip(lines, marks) if not m)
        expected[i] = (len(lines), sum(marks), spans(marks), kept)
    found = line_runs.remove_runs(docs(rows), least=least).collect()
    assert len(found) == len(rows)
    for row in found:
        assert (row.n_lines, row.n_removed, row.n_runs, row.kept_text) == expected[row.doc_id]
        assert sum(run.lines for run in row.runs) == row.n_removed
    assert line_runs.remove_runs(docs(rows).limit(0)).collect() == []


@pytest.mark.parametrize("least", [1, 3, 5])
def test_removed_short_runs_of_many_words(docs, least):
    random_ = random.Random(least)
    lines = ["a", "", "b c", "D-e f", "g h i j"]
    rows = [(i, "\n".join(random_.choice(lines) for _ in range(random_.randrange(1, 9)))) for i in range(90)]
    rows += [(200, None), (201, ""), (202, "one of its own"), (203, "one of its own"), (203, "one of its own")]
    rows += [(204, "x\n" + "w " * 60), (205, "w " * 60 + "\ny"), (206, "p\nlast of all"), (207, "last of all")]
    seen, expected = set(), {}
    for i, text in ordered(rows):
        units = text.split("\n")
        marks = [False] * len(units)
        for size in range(1, least + 1):
            for at in range(len(units) - size + 1):
                run = tuple(units[at : at + size])
                words = len(re.findall("[a-z]+", " ".join(run).lower()))
                enough = size == least or words > 5 or (size == len(units) and words > 0)
                if run in seen and enough:
                    marks[at : at + size] = [True] * size
                seen.add(run)
        kept = "\n".join(line for line, m in zip(units, marks) if not m)
        expected[i] = (len(units), sum(marks), spans(marks), kept)
    found = line_runs.remove_runs(docs(rows), least=least, words=5).collect()
    assert len(found) == len(rows)
    for row in found:
        assert (row.n_lines, row.n_removed, row.n_runs, row.kept_text) == expected[row.doc_id]
    if least == 3:
        left = {row.doc_id: row.kept_text for row in found}
        assert (left[203], left[205], left[207]) == ("", "y", "")
