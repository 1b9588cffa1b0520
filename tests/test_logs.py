import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from jobledger.functions import logs as fn
from jobledger.operators import logs as ops

OUT = "stdout: "
ERR = "\nstderr: "
DIAG = "\nYARN Diagnostics: "
POLL = "batch_id long, poll_seq long, state string, total int, lines array<string>"


@pytest.fixture
def value(rows):
    """``value(log, function)``: the function applied to one log."""
    return lambda log, function: rows([(log,)], "log array<string>").select(function("log")).first()[0]


def test_split_log(value):
    assert value([OUT, "a", ERR, "b", DIAG], fn.split_log) == ([OUT, "a"], [ERR, "b", DIAG], "ok")
    assert value([ERR, ERR], fn.split_log) == ([], [ERR, ERR], "ok")
    assert value([OUT, "stderr: "], fn.split_log) == (None, None, "no_marker")
    assert value([], fn.split_log).status == value(None, fn.split_log).status == "no_marker"
    with pytest.raises(Exception, match="no stderr header"):
        value([OUT], lambda log: fn.split_log(log, strict=True))


def test_tail(value):
    lines = [str(i) for i in range(5)]
    assert value(lines, lambda log: fn.tail(log, 2)) == ["3", "4"]
    assert value(lines, fn.tail) == lines
    assert value(lines, lambda log: fn.tail(log, 0)) == value([], fn.tail) == []


@pytest.mark.parametrize("start,size", [(None, None), (0, 0), (0, 2), (3, 9), (9, 1), (2, None)])
def test_log_page(value, start, size):
    lines = [str(i) for i in range(5)]
    first = start or 0
    end = None if size is None else first + size
    assert value(lines, lambda log: fn.log_page(log, start, size)) == lines[first:end]


def test_render(value):
    assert value(["a", "", "b"], fn.render_log) == "a\n\nb"


def test_log_checks(rows):
    data = [(["app_1 ok"], "app_1", "u"), (["User u not", "found"], "app_2", "u"), (["User u not found"], "x", "u")]
    found = ops.log_checks(
        rows(data, "log array<string>, appId string, user string"),
        present={"has_id": F.col("appId"), "literal": "ok"},
        absent={"user_known": F.concat(F.lit("User "), "user", F.lit(" not found"))},
    )
    flags = [(r.has_id, r.literal, r.user_known) for r in found.collect()]
    assert flags == [(True, True, True), (False, False, True), (False, False, False)]


def follow(polls):
    """What a reader of one job at a time would print: {job: [(poll, pos, line)]}."""
    printed, known, over = defaultdict(list), defaultdict(set), set()
    for job, seq, state, _, lines in sorted(polls, key=lambda poll: poll[:2]):
        if job in over:
            continue
        for pos, line in enumerate(lines):
            if line not in known[job]:
                known[job].add(line)
                printed[job].append((seq, pos, line))
        if state not in ("running", "starting"):
            over.add(job)
    return dict(printed)


def random_polls(seed, hot=0):
    rng = random.Random(seed)
    polls = []
    for job in range(6):
        for seq in range(rng.randint(1, 8) + (hot if job == 0 else 0)):
            state = rng.choice(["running"] * 6 + ["starting", "success", "dead"])
            if hot and job == 0 and seq < hot:
                state = "running"
            lines = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))]
            polls.append((job, seq, state, len(lines), lines))
    rng.shuffle(polls)
    return polls


@pytest.mark.parametrize("seed,hot", [(1, 0), (2, 0), (3, 400)])
def test_follow_equals_one_job_at_a_time(rows, seed, hot):
    data = random_polls(seed, hot)
    polls = ops.until_terminal(rows(data, POLL))
    found = defaultdict(list)
    for r in ops.first_seen_lines(polls).orderBy("batch_id", "poll_seq", "pos").collect():
        found[r.batch_id].append((r.poll_seq, r.pos, r.line))
    expected = follow(data)
    assert found == {job: lines for job, lines in expected.items() if lines}
    known = {r.batch_id: r.known_lines for r in ops.follow_totals(polls).collect()}
    assert known == {job: len(expected.get(job, [])) for job in known}


def test_until_terminal_edges(rows):
    data = [
        (1, 0, "success", 0, []), (1, 1, "running", 0, []),
        (2, 5, "running", 0, []), (2, 7, "dead", 0, []), (2, 6, "starting", 0, []), (2, 8, "dead", 0, []),
        (None, 1, "running", 0, []),
    ]
    found = ops.until_terminal(rows(data, POLL))
    assert found.columns == ["batch_id", "poll_seq", "state", "total", "lines"]
    kept = sorted((r.batch_id or 0, r.poll_seq) for r in found.collect())
    assert kept == [(0, 1), (1, 0), (2, 5), (2, 6), (2, 7)]


def test_follow_totals_counts_a_poll_once(rows):
    data = [(1, 0, "running", 3, ["a", "b", "a"]), (1, 1, "running", 100, []), (2, 0, "running", 4, None)]
    found = {r.batch_id: (r.total_lines, r.known_lines) for r in ops.follow_totals(rows(data, POLL)).collect()}
    assert found == {1: (103, 2), 2: (4, 0)}


def test_poll_outcome(rows):
    data = [
        (1, 0, "starting", "2024-01-01 00:00:00"), (1, 1, "running", "2024-01-01 00:01:00"),
        (2, 0, "starting", "2024-01-01 00:00:00"), (2, 1, "running", "2024-01-01 00:01:00.000001"),
        (2, 2, "success", "2024-01-01 00:02:00"), (3, 0, "dead", "2024-01-01 00:00:00"),
    ]
    polls = rows(data, "batch_id long, poll_seq long, state string, at string")
    for kind in ("timestamp", "timestamp_ntz"):
        found = ops.poll_outcome(polls.withColumn("ts", F.col("at").cast(kind)))
        outcome = {r.batch_id: (r.state, float(r.elapsed), r.timed_out) for r in found.collect()}
        assert outcome == {1: ("running", 60.0, False), 2: ("success", 120.0, True), 3: ("dead", 0.0, False)}


def test_first_app_id(rows):
    data = [(1, i, None if i < 3 else f"app_{i}") for i in range(9)]
    data += [(2, i, "late" if i == 11 else None) for i in range(12)]
    data += [(3, i, "last" if i == 10 else None) for i in range(12)]
    found = ops.first_app_id(rows(data, "batch_id long, poll_seq long, appId string"))
    assert dict(found.collect()) == {1: "app_3", 2: None, 3: "last"}
