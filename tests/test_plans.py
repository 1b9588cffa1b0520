"""Hot keys stay spread out, and plans read and shuffle no more than they need."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from jobledger.operators import logs as log_ops
from jobledger.operators import pages
from jobledger.operators import records as record_ops
from jobledger.plans import skew
from jobledger.plans.skew import lookup_join, with_key_minimum


@pytest.fixture
def plan(spark):
    def text(df):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain("formatted")
        return out.getvalue()

    return text


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def hot(spark):
    """Nine thousand rows, a third of them with key 0."""
    return spark.range(9000).selectExpr("if(id % 3 = 0, 0, id) AS job", "id AS seq")


def largest_share(df, *columns):
    """Most rows that one shuffle partition of the columns gets, of a hundred."""
    spread = df.repartition(100, *columns).groupBy(F.spark_partition_id()).count()
    return spread.agg(F.max("count")).first()[0]


def test_slots_split_a_hot_key(hot):
    assert largest_share(hot, "job") > 3000
    assert largest_share(hot.withColumn("slot", skew.slot("seq")), "job", "slot") < 300


@pytest.mark.parametrize("hot_keys", [100, 2, None])
@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
@pytest.mark.parametrize("known", ["even", "odd"])
def test_lookup_join_equals_join(hot, spark, how, known, hot_keys, no_broadcast):
    first = ["even", "odd"].index(known)
    names = spark.range(first, 9000, 2).selectExpr("id AS job", "concat('n', id) AS name")
    left = hot.union(spark.sql("SELECT NULL, -1L")).select("seq", "job")
    found = lookup_join(left, names, "job", ["seq"], how, hot_keys)
    expected = left.join(names, "job", how).select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("hot_keys", [100, 2, None])
@pytest.mark.parametrize("modulus", [7, 9])
def test_key_minimum(hot, modulus, hot_keys):
    # With modulus 9 no row of the hot key has a value.
    value = F.when(F.col("seq") % modulus == modulus - 1, F.col("seq"))
    found = with_key_minimum(hot, "job", "seq", value, "low", hot_keys)
    plain = hot.groupBy("job").agg(F.min(value).alias("low"))
    assert {r.job: r.low for r in found.collect()} == {r.job: r.low for r in plain.collect()}
    assert found.count() == 9000
    if modulus == 9:
        assert found.where("job = 0 AND low IS NOT NULL").count() == 0


@pytest.fixture
def fifty_partitions(spark, no_broadcast):
    settings = {
        "spark.sql.shuffle.partitions": "50",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_no_task_holds_a_hot_key(spark, hot, fifty_partitions):
    def most(df):
        # The last column comes from the join; without it there would be none to run.
        sizes = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(df.columns[-1]))
        return max(row.n for row in sizes.collect())

    value = F.col("seq")
    assert most(with_key_minimum(hot, "job", "seq", value, "low", 2)) > 3000
    assert most(with_key_minimum(hot, "job", "seq", value, "low", 100)) < 400
    names = spark.range(9000).selectExpr("id AS job", "'n' AS name")
    assert most(lookup_join(hot, names, "job", ["seq"], "left", 100)) < 400
    nulls = hot.selectExpr("nullif(job, 0) AS job", "seq")
    assert most(lookup_join(nulls, names, "job", ["seq"])) < 400


def test_only_hot_keys_are_broadcast(spark, plan, hot, no_broadcast):
    polls = hot.selectExpr(
        "job AS batch_id", "seq AS poll_seq", "'running' AS state", "array(string(seq)) AS lines"
    )
    shown = plan(log_ops.until_terminal(polls))
    parts = shown.split("\n\n")
    wide = [part for part in parts if "Exchange\n" in part and "lines" in part]
    assert len(wide) == 1
    assert re.search(r"Arguments: hashpartitioning\(batch_id#\d+L, _slot#\d+, ", wide[0])
    sent = [part for part in parts if ") BroadcastExchange\n" in part]
    assert len(sent) == 1 and "lines" not in sent[0]
    assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown


@pytest.mark.parametrize("operator", ["first_seen_lines", "first_app_id", "latest_records"])
def test_ranks_are_cut_before_the_shuffle(plan, hot, operator):
    polls = hot.selectExpr(
        "job AS batch_id", "seq AS poll_seq", "string(seq) AS appId", "array(string(seq)) AS lines", "seq"
    )
    if operator == "latest_records":
        shown = plan(record_ops.latest_records(polls, "seq", "batch_id"))
    else:
        shown = plan(getattr(log_ops, operator)(polls))
    tree = shown.split("\n\n(1)")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_distinct_lines_are_counted_in_two_steps(plan, hot):
    polls = hot.selectExpr("job AS batch_id", "1 AS total", "array(string(seq)) AS lines")
    shown = plan(log_ops.follow_totals(polls))
    exchanges = [part for part in shown.split("\n\n") if "Exchange\n" in part and "hashpartitioning" in part]
    assert any("line" in part.split("Arguments")[1] for part in exchanges)


def test_states_read_two_columns(spark, plan, tmp_path):
    path = str(tmp_path / "records")
    spark.sql("SELECT 1L AS id, 'n' AS name, array('x') AS log, 'dead' AS state").write.parquet(path)
    shown = plan(record_ops.states(spark.read.parquet(path), 1))
    assert "ReadSchema: struct<id:bigint,state:string>" in shown
    assert "EqualTo(id,1)" in shown
    assert "In(state, [running,starting])" in plan(record_ops.active(spark.read.parquet(path)))


def test_few_keys_are_hot_whatever_the_data(spark):
    for rows, keys in ((3000, 60), (3000, 7), (100, 100)):
        counts = spark.range(rows).selectExpr(f"id * id % {keys} AS key").groupBy("key")
        counts = counts.agg(F.count("*").alias("_n"))
        for hot_keys in (1, 5, 50):
            assert skew._hot(counts, hot_keys).count() < hot_keys


def test_lookup_filters_records_before_they_shuffle(spark, plan, tmp_path):
    spark.range(100_000).selectExpr("id", "repeat('x', 50) AS log").write.parquet(str(tmp_path / "records"))
    spark.range(5).write.parquet(str(tmp_path / "ids"))
    records, ids = (spark.read.parquet(str(tmp_path / name)) for name in ("records", "ids"))
    shown = plan(record_ops.lookup(records, ids))
    tree = shown.split("\n\n(1)")[0]
    scan = next(line for line in tree.split("\n") if "Scan parquet" in line and "log" in shown.split(line.split("(")[-1].split(")")[0] + ") Scan")[1][:300])
    above = tree.split("\n")[: tree.split("\n").index(scan)]
    depth = scan.index("Scan")
    path = []
    for line in reversed(above):
        if line.strip() and (at := len(line) - len(line.lstrip(" :+-"))) < depth:
            path.append(line.strip(" :+-").split(" (")[0])
            depth = at
    joins = [i for i, node in enumerate(path) if "Join" in node]
    shuffles = [i for i, node in enumerate(path) if node == "Exchange"]
    assert "Semi" in path[joins[0]] or "BroadcastHashJoin" in path[joins[0]]
    assert not shuffles or joins[0] < shuffles[0]


def test_page_sorts_no_wide_row(spark, plan, hot):
    wide = hot.selectExpr("seq AS id", "array(string(job)) AS log")
    shown = plan(pages.page(wide, 10, 5))
    sorts = [part for part in shown.split("\n\n") if re.match(r"\(\d+\) (Sort|Window)\b", part)]
    assert "Exchange SinglePartition" not in shown or len(sorts) >= 1
    assert "TakeOrderedAndProject" not in shown


def test_snapshots_do_not_shuffle_logs(spark, plan):
    records = spark.sql(
        "SELECT 1L AS id, 'n' AS name, 'a' AS appId, named_struct('sparkUiUrl', 'u') AS appInfo,"
        " array('x') AS log, 'dead' AS state FROM range(3)"
    )
    shown = plan(record_ops.compare_snapshots(records, records))
    assert not any("Exchange" in part and "log" in part for part in shown.split("\n\n"))
