"""Streams in several micro-batches against the batch forms and against one job at a time."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as registry
from jobledger.operators import logs as ops
from jobledger.streaming import follow, sinks
from test_logs import follow as one_job_at_a_time
from test_logs import random_polls

SCHEMA = (
    "batch_id long, poll_seq long, state string, total int, lines array<string>, big long, ts timestamp_ntz"
)
START = datetime.datetime(2024, 1, 1)


def with_extras(polls):
    """A long that a float cannot hold, null in some rows, and a time, 20 s and 7 us apart."""
    step = datetime.timedelta(seconds=20, microseconds=7)
    return [
        (*poll, None if poll[1] % 3 == 0 else 2**60 + poll[1], START + step * poll[1]) for poll in polls
    ]


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def polls(spark, tmp_path):
    """``polls(data, cuts)``: the rows as a stream with a micro-batch per range of poll_seq."""

    def make(data, cuts=(2, 4, 6)):
        folder = str(tmp_path / "polls")
        edges = [-1, *cuts, 10**9]
        for low, high in zip(edges, edges[1:]):
            rows = [row for row in data if low < row[1] <= high]
            if rows:
                spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)

    return make


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_latch_equals_batch(spark, polls, tmp_path):
    data = with_extras(random_polls(5, hot=40))
    found = follow.follow_until_terminal(polls(data), str(tmp_path / "out"))
    expected = ops.until_terminal(spark.createDataFrame(data, SCHEMA))
    assert found.columns == expected.columns
    assert rows_of(found) == rows_of(expected)


def test_latch_keeps_null_jobs_and_exact_ids(spark, polls, tmp_path):
    data = with_extras(
        [(None, 0, "running", 0, []), (2**60 + 1, 0, "running", 0, []), (2**60 + 1, 1, "running", 0, []),
         (5, 0, "dead", 0, []), (5, 1, "running", 0, []), (None, 3, "dead", 0, []), (None, 4, "running", 0, [])]
    )
    found = follow.follow_until_terminal(polls(data, (0, 2)), str(tmp_path / "out"))
    expected = ops.until_terminal(spark.createDataFrame(data, SCHEMA))
    assert rows_of(found) == rows_of(expected)
    assert found.where(f"batch_id = {2**60 + 1}").count() == 2 and found.where("batch_id IS NULL").count() == 3


def test_a_late_end_takes_back_what_was_passed_on(spark, polls, tmp_path):
    first = with_extras([(1, 5, "running", 0, ["x", "y"]), (1, 6, "running", 0, ["z"])])
    second = with_extras([(1, 1, "running", 0, ["y"]), (1, 2, "success", 0, ["w"])])
    folder, schema = str(tmp_path / "polls"), SCHEMA
    for part in (first, second):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    found = follow.follow_until_terminal(stream(), str(tmp_path / "out"))
    assert sorted(row.poll_seq for row in found.collect()) == [1, 2]
    lines = follow.follow_stream(stream(), str(tmp_path / "lines"))
    assert sorted(map(tuple, lines.collect())) == [(1, 1, 0, "y"), (1, 2, 0, "w")]


def test_latch_with_text_ids(spark, polls, tmp_path):
    data = with_extras([(1, 0, "dead", 0, []), (1, 5, "running", 0, []), (2, 5, "running", 0, [])])
    named = polls(data).withColumn("batch_id", F.concat(F.lit("job "), "batch_id"))
    found = follow.follow_until_terminal(named, str(tmp_path / "out")).collect()
    assert sorted((row.batch_id, row.poll_seq) for row in found) == [("job 1", 0), ("job 2", 5)]


def test_follow_prints_each_line_once_in_place(spark, polls, tmp_path):
    data = random_polls(7)
    found = follow.follow_stream(polls(with_extras(data)), str(tmp_path / "out"))
    expected = {
        (job, line) for job, lines in one_job_at_a_time(data).items() for _, _, line in lines
    }
    assert {(row.batch_id, row.line) for row in found.collect()} == expected
    batch = ops.first_seen_lines(ops.until_terminal(spark.createDataFrame(with_extras(data), SCHEMA)))
    assert rows_of(found) == rows_of(batch)


def test_any_order_of_arrival(spark, polls, tmp_path):
    """Polls dealt to micro-batches at random: ends and first places move as earlier ones arrive."""
    data = with_extras(random_polls(11, hot=30))
    shuffled = random.Random(1).sample(data, len(data))
    folder = str(tmp_path / "polls")
    for part in range(4):
        rows = shuffled[part::4]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)

    whole = spark.createDataFrame(data, SCHEMA)
    kept = ops.until_terminal(whole)
    assert rows_of(follow.follow_until_terminal(stream(), str(tmp_path / "a"))) == rows_of(kept)
    assert rows_of(follow.follow_stream(stream(), str(tmp_path / "b"))) == rows_of(ops.first_seen_lines(kept))


def test_state_is_a_row_a_job_that_is_over(spark, polls, tmp_path):
    data = with_extras([(job, seq, "dead" if seq > 3 and job < 5 else "running", 0, ["x"]) for job in range(8) for seq in range(7)])
    progress = sinks.drain(follow.job_ends(polls(data, (1, 3, 5))), str(tmp_path / "ends"))
    # Active polls do not get past the scan.
    assert [p["numInputRows"] for p in progress][-2:] == [16, 8]
    assert [p["stateOperators"][0]["numRowsTotal"] for p in progress] == [0, 0, 5, 5]
    found = sinks.state_rows(spark, str(tmp_path / "ends"), T.StructType.fromDDL("batch_id long, over long"), "end")
    assert sorted(map(tuple, found.collect())) == [(job, 4) for job in range(5)]


def test_lines_touch_only_the_keys_of_a_micro_batch(spark, tmp_path):
    """The hundredth micro-batch: as many rows read and updated as the second, whatever was printed."""
    folder, schema = str(tmp_path / "in"), "batch_id long, poll_seq long, state string, lines array<string>"
    for i in range(12):
        spark.createDataFrame([(1, i, "running", ["again", f"line {i}"])], schema).coalesce(1).write.mode("append").json(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
    progress = sinks.drain(follow.first_places(stream), str(tmp_path / "lines"), mode="update")
    states = [p["stateOperators"][0] for p in progress]
    assert [s["numRowsTotal"] for s in states] == [2 + i for i in range(12)]
    assert all(s["numRowsUpdated"] == 2 for s in states) and all(p["numInputRows"] == 1 for p in progress)
    assert [len(p["sources"]) for p in progress] == [1] * 12
    plan = follow.first_places(stream)._jdf.queryExecution().logical().toString()
    assert plan.count("StreamingRelation") == 1 and "Join" not in plan


def test_new_lines_come_out_once_and_a_horizon_forgets_them(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "batch_id long, poll_seq long, ts timestamp_ntz, lines array<string>"
    times = [0, 10, 200, 210, 400, 410]
    for i, seconds in enumerate(times):
        at = START + datetime.timedelta(seconds=seconds)
        line = "late" if i == 5 else "same"
        spark.createDataFrame([(1, i, at, [line])], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    def run(label, **how):
        out = str(tmp_path / label)
        progress = sinks.drain(follow.new_lines(stream, **how), out, table=True)
        rows = spark.read.parquet(f"{out}/table").collect()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
        return sorted((row.poll_seq, row.line) for row in rows), held

    assert run("whole") == ([(0, "same"), (5, "late")], [1, 1, 1, 1, 1, 2])
    lines, held = run("bounded", at="ts", horizon="60 seconds")
    # The micro-batch at 200 s moves the watermark past the line, the one after it drops the line.
    assert lines == [(0, "same"), (4, "same"), (5, "late")] and held[3] == 0
    with pytest.raises(ValueError):
        follow.new_lines(stream, horizon="60 seconds")


def test_stuck_jobs_equal_outcome(spark, polls, tmp_path):
    data = with_extras(random_polls(8, hot=10))
    found = follow.stuck_jobs(polls(data), str(tmp_path / "out")).where("NOT silent").collect()
    batch = ops.poll_outcome(ops.until_terminal(spark.createDataFrame(data, SCHEMA)))
    whole = {row.batch_id for row in batch.collect() if row.timed_out and row.batch_id is not None}
    waited = {row.batch_id: row.waited for row in found}
    assert set(waited) == whole and waited and all(seconds > 60 for seconds in waited.values())
    assert len(found) == len(waited)


def test_a_silent_job_is_told_of_by_the_clock(spark, polls, tmp_path):
    data = with_extras([(1, 0, "running", 0, []), (2, 0, "running", 0, []), (2, 1, "success", 0, []), (2, 2, "running", 0, [])])
    stream, out = polls(data, (0,)), str(tmp_path / "out")
    assert follow.stuck_jobs(stream, out, timeout=30).where("silent").count() == 0
    # Nothing new but time: what ran is held in full, what is over only by its end.
    whole = sinks.state_rows(spark, out, T.StructType.fromDDL("batch_id long, first long, active long, told long, since long"), "watch")
    assert [row.batch_id for row in whole.collect()] == [1]
    short = str(tmp_path / "short")
    follow.stuck_jobs(stream, short, timeout=1)
    time.sleep(2)
    found = follow.stuck_jobs(stream, short, timeout=1).collect()
    assert [row.batch_id for row in found if row.silent] == [1]


def test_a_watched_job_is_told_of_while_the_query_runs(spark, polls, tmp_path):
    data = with_extras([(1, 0, "running", 0, []), (2, 0, "success", 0, [])])
    out = str(tmp_path / "out")
    query = sinks.start(follow.watched(polls(data), timeout=1), out, table=True, processingTime="500 milliseconds")
    schema = T.StructType.fromDDL("batch_id long, waited long, silent boolean")
    try:
        for _ in range(60):
            found = sinks.sink_rows(spark, out, schema).collect()
            if found:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert [(row.batch_id, row.silent) for row in found] == [(1, True)] and found[0].waited >= 1_000_000


def test_a_run_goes_on_from_its_checkpoint(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "batch_id long, poll_seq long, state string, lines array<string>"

    def add(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)

    def run():
        found = follow.follow_stream(spark.readStream.schema(schema).json(source), out).collect()
        return sorted((row.batch_id, row.line) for row in found)

    add((1, 0, "running", ["a"]), (2, 0, "success", ["a"]))
    assert run() == [(1, "a"), (2, "a")]
    add((1, 1, "running", ["a", "b"]), (2, 1, "running", ["late"]))
    assert run() == [(1, "a"), (1, "b"), (2, "a")]


def test_without_input(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("batch_id long, poll_seq long, state string").json(str(tmp_path / "in"))
    assert follow.follow_until_terminal(stream, str(tmp_path / "out")).collect() == []


def test_a_stream_has_files_by_size_and_takes_a_third_at_a_time(spark, tmp_path, monkeypatch):
    data = with_extras(random_polls(9, hot=60)) + [(3, None, "running", 0, ["late"], None, None)] * 2
    polls = spark.createDataFrame(data, SCHEMA)
    monkeypatch.setattr(registry, "fresh_dir", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(registry, "FILE_BYTES", 300)
    stream = registry.stream(spark, polls, "polls")
    files = spark.read.schema(polls.schema).parquet(str(tmp_path / "polls")).inputFiles()
    assert len(files) > 6
    done = sinks.drain(stream, str(tmp_path / "out"), table=True)
    assert len(done) == 3
    assert rows_of(sinks.sink_rows(spark, str(tmp_path / "out"), polls.schema)) == rows_of(polls)
    assert sinks.drain(registry.stream(spark, polls.limit(0), "none"), str(tmp_path / "none-out"), table=True) is not None
    assert sinks.sink_rows(spark, str(tmp_path / "none-out"), polls.schema).collect() == []
