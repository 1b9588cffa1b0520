"""Quality rules against a loop, and cutoffs against sums of binomial terms."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from jobledger.llm import quality_rules as qr

WORD = re.compile("[^\x20\x09-\x0d]+")


def counted(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def failed(counts):
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, text int")


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_counts_against_a_loop(docs, labels):
    random_ = random.Random(4)
    pieces = ["a", "b", "été", "\U0001f600", "\n", "\n\n", "\t", "\x0b", " ", "\xa0", "#", "x|y", "a b c", "A"]
    rows = [(i, "".join(random_.choice(pieces) + random_.choice(("", " ")) for _ in range(random_.randrange(200)))) for i in range(80)]
    rows += [(None, None), (5, ""), (6, " \n\x0c"), (7, "a b c"), (7, "a b c"), (8, "a b c a b c"), (9, "a a a a"), (10, "w\n" * 3000)]
    got = rows_of(qr.quality_rules(docs(rows), labels([]), stratum="source"))
    want = [(i, *counted(t), failed(counted(t)), not failed(counted(t)), "") for i, t in rows]
    assert got == sorted(want, key=str)


def test_the_tail_is_that_of_the_binomial(spark):
    cases = [(0, 1), (0, 500), (3, 900), (40, 10_000), (0, 100_000), (399, 100_000), (4000, 1_000_000)]
    table = spark.createDataFrame(cases, "k long, n long")
    for k, n, tail in table.select("k", "n", qr.binomial_tail(F.col("k"), F.col("n"), 0.004)).collect():
        term = lambda i: math.exp(
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.004) + (n - i) * math.log1p(-0.004)
        )
        assert tail == pytest.approx(math.fsum(map(term, range(k + 1))), rel=1e-7)


def labelled(spark, rows):
    names = list(qr.MEASURES)
    full = [(s, g, *[v if m == "symbols" else 0 for m in names]) for s, g, v in rows]
    return spark.createDataFrame(full, f"stratum string, good boolean, {', '.join(f'{m} long' for m in names)}")


def test_cutoffs_reject_few_good_documents(spark):
    # Two strata: 3,000 good ones with 6 of them at 30 or more, and one with too few labels.
    rows = [("=a", True, 30 if i < 6 else i % 20) for i in range(3000)] + [("=a", False, 10 + i % 50) for i in range(500)]
    rows += [("=b", True, 0)] * 40 + [("=b", False, 90)] * 40 + [("", False, 5)] * 10
    found = {(r.stratum, r.measure): r for r in qr.cutoffs(labelled(spark, rows), 0.05, 0.05).collect()}
    assert set(found) == {("=a", "symbols")}
    best = found["=a", "symbols"]
    # Values below 20 reject too many; between 20 and 30 all reject the same six, and more bad ones.
    assert (best.cutoff, best.n_good, best.n_rejected) == (20, 3000, 6)
    assert best.tail <= 0.05 / (3 * len(qr.MEASURES))


def test_false_rejections_stay_below_alpha(spark):
    """Cutoffs of many draws: the share of good documents that they reject in truth."""
    wrong = 0
    for seed in range(15):
        random_ = random.Random(seed)
        rows = [("=a", True, random_.randrange(1000)) for _ in range(1200)]
        rows += [("=a", False, random_.randrange(400, 1400)) for _ in range(300)]
        found = qr.cutoffs(labelled(spark, rows), 0.1, 0.05).collect()
        wrong += any((1000 - row.cutoff) / 1000 > 0.1 / len(qr.MEASURES) for row in found)
    assert wrong <= 2


def test_verdicts_by_stratum(docs, labels, prose):
    good = [(3 * i, prose(80, i)) for i in range(1000)]  # source s0
    bad = [(30_000 + 3 * i, prose(60, i) + " # | *" * 4) for i in range(60)]
    other = [(40_000 + 3 * i, prose(60, i) + " # | *" * 4) for i in range(5)]  # source s1, without labels
    odd = [(None, "# " * 60), (90_000, None), (90_003, ""), (90_006, bad[0][1]), (90_006, bad[0][1])]
    known = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 0, 0), (7, None, 0), (30_000, None, 0)]
    got = {}
    for row in qr.quality_rules(docs(good + bad + other + odd), labels(known), stratum="source", alpha=0.05).collect():
        got.setdefault(row.doc_id, []).append((row.kept, row.rejected_by, row.base_failed))
    assert all(got[i] == [(True, "", False)] for i, _ in good)
    assert all(kept is False and "symbols" in by for i, _ in bad for kept, by, _ in got[i])
    assert all(got[i] == [(True, "", False)] for i, _ in other)
    assert [kept for kept, *_ in got[90_006]] == [False, False] and got[90_000] == [(False, "", True)]
    assert qr.quality_rules(docs(good).limit(0), labels(known), stratum="source").count() == 0


def test_no_python_in_the_plan(docs, labels):
    plan = qr.counts(docs([(1, "x")]), stratum="source")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
