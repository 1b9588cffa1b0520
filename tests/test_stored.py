"""Bloom filters at the scan, snapshots in buckets, listings as a stream, configurations in files."""

import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from jobledger.operators import records as ops
from jobledger.operators.overlay import overlay
from jobledger.operators.sampling import worker_inventory
from jobledger.plans import bloom
from jobledger.sources import configs, snapshots
from jobledger.sources.records import job_listing, job_records
from jobledger.streaming import listings


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_a_bloom_filter_lets_all_of_its_keys_through(spark, monkeypatch, kind):
    records = spark.range(20_000).select(F.col("id").cast(kind))
    keys = spark.range(0, 20_000, 7).select(F.col("id").cast(kind))
    found = bloom.maybe_among(records, keys.union(spark.sql("SELECT NULL")), "id")
    assert keys.join(found, "id", "left_anti").count() == 0
    assert found.count() < 1.1 * keys.count()
    monkeypatch.setattr(bloom, "BLOCKS", 1)
    monkeypatch.setattr(bloom, "BITS", 1 << 15)
    full = bloom.maybe_among(records, keys, "id")  # as full as may be, but without a miss
    assert keys.join(full, "id", "left_anti").count() == 0


def test_lookup_with_a_bloom_filter(spark):
    records = spark.range(5000).selectExpr("id", "concat('s', id) AS state")
    ids = spark.range(4990, 5010).union(spark.range(3)).union(spark.range(3)).repartition(3)
    found = ops.lookup(records, ids, bloom=True)
    assert sorted((r.id, r.state, r.found) for r in found.collect()) == sorted(
        (i, f"s{i}" if i < 5000 else None, i < 5000) for i in [0, 1, 2, *range(4990, 5010)]
    )
    assert ops.lookup(records, ids.limit(0), bloom=True).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan_of(ops.lookup(records, ids, bloom=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Going up from the scan of the records, the filter comes before the first shuffle.
    lines = [line.strip(" :+-") for line in shown.splitlines()]
    scan = next(i for i, line in enumerate(lines) if "Range (0, 5000" in line)
    up = lines[:scan][::-1]
    depth = lambda text: next(i for i, line in enumerate(up) if text in line)
    assert depth("BroadcastHashJoin [_block") < depth("Exchange hashpartitioning(id")
    assert depth("getbit") < depth("Exchange hashpartitioning(id")


def test_stored_snapshots_compare_without_a_shuffle(spark):
    make = lambda low, high, state: spark.range(low, high).selectExpr(
        "id", "concat('n', id % 5) AS name", "string(null) AS appId",
        "named_struct('sparkUiUrl', 'u') AS appInfo", f"if(id % 10 = 0, '{state}', 'running') AS state",
    )
    a, b = make(0, 300, "dead"), make(20, 320, "success")
    run = uuid.uuid4().hex
    stored = [snapshots.write_snapshot(t, f"{n}_{run}", 4) for n, t in (("a", a), ("b", b))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ops.compare_snapshots(*stored)
        assert "Exchange" not in plan_of(found) and "SortMergeJoin" in plan_of(found)
        assert sorted(found.collect()) == sorted(ops.compare_snapshots(a, b).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def reply(start, ids, state):
    jobs = [{"id": i, "name": None, "appId": None, "appInfo": None, "log": [], "state": f"{state}{i}"} for i in ids]
    return {"from": start, "total": len(ids), "snapshot": int(state[1:].split("-")[0]), "sessions": jobs}


def files_of(folder):
    return {
        (top, name): os.stat(os.path.join(top, name)).st_mtime_ns
        for top, _, names in os.walk(folder) for name in names if name.endswith(".parquet")
    }


def test_streamed_listings_keep_the_latest(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    os.mkdir(source)
    random_ = random.Random(3)
    numbers = random_.sample(range(5), 5)
    for place, number in enumerate(numbers):
        ids = random_.sample(range(40), 12)
        with open(f"{source}/{place}.json", "w") as out:
            out.write(json.dumps(reply(0, ids[:6], f"s{number}-")) + "\n" + json.dumps(reply(6, ids[6:] + ids[:1], f"s{number}-")))

    def run():
        stream = job_listing(spark, source, arrival="snapshot", stream=True, files_per_trigger=1)
        return listings.latest_listing(stream, folder, 4)

    def expected():
        return sorted(map(str, job_records(spark, source, arrival="snapshot").collect()))

    assert sorted(map(str, run().collect())) == expected()
    before = files_of(f"{folder}/table")
    with open(f"{source}/last.json", "w") as out:
        out.write(json.dumps(reply(0, [7], "s9-")))
    assert sorted(map(str, run().collect())) == expected()
    after = files_of(f"{folder}/table")
    changed = {os.path.basename(top) for top, name in set(before.items()) ^ set(after.items()) for top, name in [top]}
    bucket = spark.range(7, 8).select(F.pmod(F.xxhash64("id"), F.lit(4))).first()[0]
    assert changed == {f"_bucket={bucket}"}


def test_a_micro_batch_that_is_tried_again_changes_nothing(spark, tmp_path):
    schema = "id long, state string, arrival long, listing_pos long"
    merge = listings.keep_latest(str(tmp_path / "out"), 3)
    first = spark.createDataFrame([(1, "a", 1, 0), (2, "a", 1, 1), (1, "b", 1, 2)], schema)
    second = spark.createDataFrame([(1, "old", 0, 9), (3, "c", 2, 0)], schema)
    for epoch, rows in ((0, first), (0, first), (1, second), (1, second)):
        merge(rows, epoch)
    found = listings.latest_table(spark, str(tmp_path / "out"), first.schema)
    assert sorted(map(tuple, found.collect())) == [(1, "b", 1, 2), (2, "a", 1, 1), (3, "c", 2, 0)]


def test_no_listing_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = job_listing(spark, str(tmp_path / "in"), arrival="snapshot", stream=True)
    assert listings.latest_listing(stream, str(tmp_path / "out"), 4).collect() == []


def test_equal_places_of_a_layer_do_not_depend_on_the_order(rows):
    data = [(1, 1, 0, "k", "b"), (1, 1, 0, "k", "a"), (1, 1, 0, "k", None), (1, 0, 5, "k", "z")]
    for shuffled in (data, data[::-1]):
        found = overlay(rows(shuffled, "job_id long, layer int, seq int, key string, value string"))
        assert found.collect() == [(1, "k", "b")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_the_later_of_two_files_of_a_job_wins(spark, tmp_path, multi_line):
    texts = {"10.json": {"driverMemory": "1g", "queue": "a"}, "20.json": {"driverMemory": "2g"}}
    for name, settings in texts.items():
        (tmp_path / name).write_text(json.dumps(settings) + ("\n" if multi_line else '\n{"driverMemory": "9g", "name": "%s"}\n' % name))
    for paths in ([str(tmp_path / n) for n in texts], [str(tmp_path / n) for n in reversed(texts)], str(tmp_path)):
        scanned = configs.tool_scan(spark, paths, multi_line).withColumn("job", F.lit(1)).repartition(3)
        found = {row.key: row.value for row in overlay(configs.tool_layer(scanned, "job")).collect()}
        last = {"driverMemory": "2g"} if multi_line else {"driverMemory": "9g", "name": "20.json"}
        assert found == {"queue": "a", **last}


def test_missing_paths_are_left_out(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    here, gone = str(tmp_path / "a.json"), [str(tmp_path / f"no{i}") for i in range(3)]
    assert configs.tool_scan(spark, [gone[0], here, *gone[1:]]).count() == 1
    assert configs.config_scan(spark, gone).count() == 0


def test_every_slice_is_seen_at_once(spark):
    slots = spark.sparkContext.defaultParallelism
    found = worker_inventory(spark.range(1000), slices=slots, together=True).collect()
    assert sum(row.elements for row in found) == 1000 and sum(row.slices for row in found) == slots
    empty = worker_inventory(spark.range(0), slices=slots, together=True).collect()
    assert sum(row.elements for row in empty) == 0 and sum(row.slices for row in empty) == slots
    assert sum(row.elements for row in worker_inventory(spark.range(10)).collect()) == 10


def test_a_large_directory_of_a_listing_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listings, "TASK_ROWS", 100)
    merge = listings.keep_latest(str(tmp_path / "out"), 2)
    rows = spark.range(1000).selectExpr("id", "0 AS arrival", "id AS listing_pos", "concat('a', id) AS name")
    merge(rows, 0)
    merge(rows.where("id < 300").withColumn("arrival", F.lit(1)).withColumn("name", F.lit("b")), 1)
    found = listings.latest_table(spark, str(tmp_path / "out"), rows.schema)
    assert len(found.inputFiles()) >= 8  # two directories
    assert sorted((r.id, r.name) for r in found.collect()) == [(i, "b" if i < 300 else f"a{i}") for i in range(1000)]


def test_listings_are_written_by_many_tasks_the_later_one_first(spark, tmp_path, monkeypatch):
    orders = spark.range(3000).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "CASE WHEN id % 2 = 0 THEN 'F' ELSE 'O' END AS o_orderstatus"
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(registry, "fresh_dir", lambda spark, label: str(tmp_path / label))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = registry.job_records_stream(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set(name, before)
    assert len(spark.read.text(str(tmp_path / "listing")).inputFiles()) > 4
    assert sorted((r.id, r.state, r.arrival) for r in found) == [
        (i, "dead", 1) if i % 2 == 0 else (i, "starting", 0) for i in range(3000)
    ]
