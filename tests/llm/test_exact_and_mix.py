"""Exact duplicates and the mix against plain Python."""

import collections
import hashlib
import re

import pytest
from conftest import ODD
from pyspark.sql import functions as F

from jobledger.llm import exact_dedup, fair_mix
from jobledger.llm.tables import lower_ascii


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("largest", [False, True])
def test_groups_equal_a_dictionary(docs, weak, largest):
    rows = [*ODD, (20, "ÄB c"), (21, "Äb C"), (22, "äb c"), (23, "WORD")]
    hashed = (lambda text: F.length(text) % 2) if weak else exact_dedup.content_hash
    found = exact_dedup.exact_duplicates(
        docs(rows), normalise=lower_ascii, hashed=hashed, largest=largest
    ).collect()
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[lowered(text)].append(i)
    expected = []
    for i, text in rows:
        group = groups[lowered(text)]
        ids = [x for x in group if x is not None]
        keep = (max if largest else min)(ids) if ids else None
        sha = hashlib.sha256(lowered(text).encode()).hexdigest()
        expected.append((i, keep, len(group), i == keep, sha))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_exact_of_nothing(docs):
    assert exact_dedup.exact_duplicates(docs([(1, "a")]).limit(0)).collect() == []


def poured(sizes, weights, most):
    """Targets by raising the water level source by source."""
    total, full = sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        open_ = [s for s in sizes if s not in full]
        level = left / sum(weights[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weights[s] > most * sizes[s]]
        if not over:
            return full | {s: level * weights[s] for s in open_}
        full |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [(10, 10, 10), (1, 100, 3, 50, 7), (1, 1, 1000), (5,), (0, 9, 4)])
def test_targets(spark, sizes):
    table = {f"s{i}": n for i, n in enumerate(sizes)}
    weights = {f"s{i}": i % 3 + 1 for i in range(len(sizes))}
    df = spark.createDataFrame(list(table.items()), "source string, source_size long")
    found = fair_mix.source_targets(df, lambda rank: fair_mix.cyclic_weight(rank, 3), 1.0, 3).collect()
    expected = poured(table, weights, 3)
    assert {r.source: pytest.approx(r.target) for r in found} == expected


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_mix(docs, prose, monkeypatch, bucket_rows):
    monkeypatch.setattr(fair_mix, "BUCKET_ROWS", bucket_rows)
    rows = [*ODD, *[(100 + i, prose(i % 40, i)) for i in range(300)]]
    df = docs(rows)
    found = fair_mix.fair_mix(df).collect()
    assert len(found) == len(rows)
    taken, targets, largest = collections.Counter(), {}, max(r.size for r in found)
    for row in found:
        assert 0 <= row.copies <= 3
        taken[row.source] += row.size * row.copies
        targets[row.source] = row.target
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * largest
    again = sorted(map(str, fair_mix.fair_mix(df.repartition(5)).collect()))
    assert again == sorted(map(str, found))
    out = fair_mix.mixed(df)
    assert out.columns == df.columns
    assert out.count() == sum(r.copies for r in found)


def test_ranges_are_even_where_a_third_and_more_finish_at_once(spark):
    rows = spark.range(4000).selectExpr("if(id % 4 = 0, id / 4000, 0.5) AS finish", "md5(string(id)) AS mark", "id")
    found = fair_mix.in_ranges(rows, ["finish", "mark", "id"], 20).collect()
    sizes = collections.Counter(r._slice for r in found)
    assert sum(sizes.values()) == 4000 and max(sizes.values()) < 3 * 4000 / 20
    slices = [r._slice for r in sorted(found, key=lambda r: (r.finish, r.mark))]
    assert slices == sorted(slices)


def test_mix_of_a_source_of_empty_texts(docs, monkeypatch):
    monkeypatch.setattr(fair_mix, "BUCKET_ROWS", 50)
    rows = [(3 * i, "") for i in range(400)] + [(0, "a b c")] + [(3 * i + 1, "d e") for i in range(30)]
    found = fair_mix.fair_mix(docs(rows)).collect()
    assert len(found) == len(rows)
    taken = collections.Counter()
    for row in found:
        taken[row.source] += row.size * row.copies
    for source, target in {(r.source, r.target) for r in found}:
        assert abs(taken[source] - target) <= 6


def test_mix_of_nothing_and_of_empty_texts(docs):
    assert fair_mix.fair_mix(docs([(1, "a")]).limit(0)).collect() == []
    assert fair_mix.mixed(docs([(1, "a")]).limit(0)).collect() == []
    assert {(r.size, r.copies) for r in fair_mix.fair_mix(docs([(1, None), (2, "")])).collect()} == {(0, 1)}
