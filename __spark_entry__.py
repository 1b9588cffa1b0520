"""Registered queries: which columns of the given tables feed each operator, and the same in SQL."""

from __future__ import annotations

import math
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobledger.functions import artifacts, logs, text
from jobledger.operators import logs as polls_ops
from jobledger.operators import overlay as overlay_ops
from jobledger.operators import pages as page_ops
from jobledger.operators import records as record_ops
from jobledger.operators import requests as request_ops
from jobledger.operators import sampling
from jobledger.plans.session import fresh_dir
from jobledger.schemas import STDERR_MARKER
from jobledger.sources import configs, snapshots, staging
from jobledger.sources import records as record_sources
from jobledger.streaming import follow, listings

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        _QUERIES[run.__name__] = run
        if sql is not None:
            _ORACLE[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- Inputs derived from the tables, as DataFrames and as SQL ---------------------------------


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as job records."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.expr("CASE WHEN o_custkey % 5 <> 0 THEN concat('job-', o_custkey) END").alias("name"),
        F.expr("CASE WHEN o_orderkey % 3 <> 0 THEN concat('app_', o_orderkey) END").alias("appId"),
        F.struct(
            F.lit(None).cast("string").alias("driverLogUrl"),
            F.concat(F.lit("http://ui/"), "o_orderkey").alias("sparkUiUrl"),
        ).alias("appInfo"),
        F.array(F.lit("stdout: "), F.lit(STDERR_MARKER)).alias("log"),
        F.expr("decode(o_orderstatus, 'F', 'success', 'P', 'running', 'starting')").alias("state"),
    )


JOBS = """(SELECT o_orderkey AS id,
    CASE WHEN o_custkey % 5 <> 0 THEN 'job-' || o_custkey END AS name,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'app_' || o_orderkey END AS appId,
    'http://ui/' || o_orderkey AS ui,
    CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'running' ELSE 'starting' END AS state
    FROM orders)"""


def doc_polls(docs: DataFrame) -> DataFrame:
    """Documents as polls: the source is the job, a document one look at its log."""
    return docs.select(
        F.col("source").alias("batch_id"),
        F.col("doc_id").alias("poll_seq"),
        F.expr("CASE WHEN doc_id % 101 = 100 THEN 'success' ELSE 'running' END").alias("state"),
        F.split("text", "\n").alias("lines"),
    )


DOC_POLLS = """(SELECT source AS batch_id, doc_id AS poll_seq,
    CASE WHEN doc_id % 101 = 100 THEN 'success' ELSE 'running' END AS state,
    string_split(text, chr(10)) AS lines FROM documents)"""


def event_polls(events: DataFrame) -> DataFrame:
    """Events as polls: the user is the job, clicks and views are looks at an active one."""
    return events.select(
        F.col("user_id").alias("batch_id"),
        F.col("event_id").alias("poll_seq"),
        F.expr("decode(event_type, 'click', 'running', 'view', 'starting', event_type)").alias("state"),
        F.expr("CASE WHEN event_type = 'purchase' THEN concat('app_', event_id) END").alias("appId"),
        "ts",
    )


EVENT_POLLS = """(SELECT user_id AS batch_id, event_id AS poll_seq,
    CASE event_type WHEN 'click' THEN 'running' WHEN 'view' THEN 'starting' ELSE event_type END AS state,
    CASE WHEN event_type = 'purchase' THEN 'app_' || event_id END AS appId, ts FROM events)"""


def until_terminal_sql(polls: str) -> str:
    return f"""(SELECT * FROM (SELECT *, coalesce(max(CASE WHEN state NOT IN ('running', 'starting')
        THEN 1 ELSE 0 END) OVER (PARTITION BY batch_id ORDER BY poll_seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM {polls}) WHERE ended = 0)"""


def first_seen_sql(polls: str) -> str:
    return f"""(SELECT batch_id, poll_seq, pos, line FROM (SELECT *, row_number() OVER
        (PARTITION BY batch_id, line ORDER BY poll_seq, pos) AS rn FROM (SELECT batch_id, poll_seq,
        unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM {polls})) WHERE rn = 1)"""


def doc_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as logs whose lines that start with D are the stderr header."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.when(line.startswith("D"), F.lit(STDERR_MARKER)).otherwise(line),
    )
    return table(spark, sf_dir, "documents").select("doc_id", "lang", lines.alias("log"))


DOC_LOGS = """(SELECT doc_id, lang, list_transform(string_split(text, chr(10)), lambda line:
    CASE WHEN line LIKE 'D%' THEN chr(10) || 'stderr: ' ELSE line END) AS log FROM documents)"""

# The page addresses as artifacts: most on the cluster, some local, some with a scheme to reject.
URI = """CASE WHEN url LIKE 'https://%' THEN 'hdfs://' || substr(url, 9)
    WHEN page_id % 5 < 2 THEN url ELSE '/' || substr(url, 8) END"""


def joined(lines: Column) -> Column:
    return F.array_join(lines, "\n")


# --- Scans, sources, sinks --------------------------------------------------------------------


@query(f"""SELECT id, name, appId, ui, CASE WHEN id % 2 = 0 THEN 'dead' ELSE state END AS state,
    CASE WHEN id % 2 = 0 THEN 1 ELSE 0 END AS arrival,
    CASE WHEN id % 2 = 0 THEN id // 100 * 100 + row_number() OVER (PARTITION BY id // 100, id % 2 ORDER BY id) - 1
    ELSE id // 100 * 100 + row_number() OVER (PARTITION BY id // 100 ORDER BY id) - 1 END AS listing_pos
    FROM {JOBS}""")
def job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listings stored as JSON replies; the later and shorter one has the even ids, further up."""
    path = fresh_dir(spark, "listing")
    second, first = _listings(spark, sf_dir)
    second.unionByName(first).write.json(path)
    return _listed(record_sources.job_records(spark, path, arrival="snapshot"))


@query(_ORACLE["job_records"])
def job_records_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same listings as a stream, the later one first, into a table of the latest records."""
    path = fresh_dir(spark, "listing")
    second, first = _listings(spark, sf_dir)
    second.write.json(path)
    whole = len(spark.read.text(path).inputFiles())  # the later listing is a micro-batch of its own
    first.write.mode("append").json(path)
    stream = record_sources.job_listing(spark, path, arrival="snapshot", stream=True, files_per_trigger=whole)
    return _listed(listings.latest_listing(stream, fresh_dir(spark, "latest"), 8))


def _listed(records: DataFrame) -> DataFrame:
    return records.select(
        "id", "name", "appId", F.col("appInfo.sparkUiUrl").alias("ui"), "state", "arrival", "listing_pos"
    )


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The replies of two listings, the later one first."""
    first = jobs(spark, sf_dir)
    second = first.where("id % 2 = 0").withColumn("state", F.lit("dead"))

    def replies(listed: DataFrame, snapshot: int) -> DataFrame:
        # A reply holds the jobs of a hundred ids.
        pages = listed.groupBy(F.floor(F.col("id") / 100).alias("page"))
        job = F.struct("id", "name", "appId", "appInfo", "state", "log")
        return pages.agg(F.array_sort(F.collect_list(job)).alias("sessions")).select(
            (F.col("page") * 100).alias("from"),
            F.size("sessions").alias("total"),
            F.lit(snapshot).alias("snapshot"),
            "sessions",
        )

    return replies(second, 1), replies(first, 0)


CONFIG_STATUS = """CASE WHEN event_id % 11 = 10 THEN 'malformed' WHEN event_id % 4 = 0 THEN 'no_credentials'
    WHEN event_id % 6 = 5 THEN 'no_port' ELSE 'ok' END"""


@query(f"""SELECT CASE WHEN status = 'ok' THEN 'http://h' || event_id END AS url,
    CASE WHEN status = 'ok' THEN CAST(8000 + event_id % 100 AS VARCHAR) END AS port,
    CASE status WHEN 'ok' THEN 'http://h' || event_id || ':' || (8000 + event_id % 100)
        WHEN 'no_port' THEN 'h' || event_id END AS address,
    CASE WHEN status <> 'malformed' AND event_id % 5 <> 0 THEN json_extract_string(props, '$.k') END AS cores,
    CASE WHEN status <> 'malformed' AND event_id % 5 <> 0 THEN 2 ELSE 0 END AS n_settings, status
    FROM (SELECT *, {CONFIG_STATUS} AS status FROM events)""")
def config_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration per event; some lack credentials, a port or settings, some are cut short."""
    document = F.to_json(
        F.struct(
            F.expr(
                "CASE WHEN event_id % 4 <> 0 THEN named_struct('url', CASE WHEN event_id % 6 = 5 THEN"
                " concat('h', event_id) ELSE concat('http://h', event_id, ':', 8000 + event_id % 100) END) END"
            ).alias("kernel_python_credentials"),
            F.expr(
                "CASE WHEN event_id % 5 <> 0 THEN named_struct('executorCores',"
                " int(get_json_object(props, '$.k')), 'driverMemory', '1g') END"
            ).alias("session_configs"),
            F.lit(True).alias("ignored"),
        )
    )
    cut = F.when(F.expr("event_id % 11 = 10"), F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))
    path = fresh_dir(spark, "configs")
    rows = table(spark, sf_dir, "events").withColumn("value", document)
    rows.select(cut.alias("value")).write.text(path)
    found = configs.config_scan(spark, path, multi_line=False)
    return found.select(
        "url",
        "port",
        "address",
        F.col("session_configs")["executorCores"].alias("cores"),
        F.size("session_configs").alias("n_settings"),
        "status",
    )


@query("SELECT * FROM orders")
def staged_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: orders written to a run directory and read back."""
    orders = table(spark, sf_dir, "orders")
    path = staging.staged_write(orders, "svc", root=fresh_dir(spark, "user"))
    return spark.read.parquet(path)


# --- Projections, filters, joins, limits over records -----------------------------------------


@query(f"""SELECT p.id, j.id IS NOT NULL AS found, j.state, j.name, j.ui FROM
    (SELECT DISTINCT p_partkey * 10 AS id FROM part) p LEFT JOIN {JOBS} j ON p.id = j.id""")
def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1"""
    ids = table(spark, sf_dir, "part").select((F.col("p_partkey") * 10).alias("id"))
    found = record_ops.lookup(jobs(spark, sf_dir), ids)
    return found.select("id", "found", "state", "name", F.col("appInfo.sparkUiUrl").alias("ui"))


@query(_ORACLE["lookup"])
def lookup_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids whose number Spark does not know, by a Bloom filter."""
    ids = table(spark, sf_dir, "part").select((F.col("p_partkey") * 10).alias("id"))
    found = record_ops.lookup(jobs(spark, sf_dir), ids, bloom=True)
    return found.select("id", "found", "state", "name", F.col("appInfo.sparkUiUrl").alias("ui"))


@query(f"SELECT id, state FROM {JOBS}")
def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2"""
    return record_ops.states(jobs(spark, sf_dir))


@query(f"SELECT id, name, state FROM {JOBS} WHERE state IN ('running', 'starting')")
def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3"""
    return record_ops.active(jobs(spark, sf_dir)).select("id", "name", "state")


@query("""SELECT doc_id, contains(text, '@') AS has_at, contains(text, lang) AS has_lang,
    NOT contains(text, 'Permission denied') AS allowed, NOT contains(text, 'User ' || lang || ' not found')
    AS known_user FROM documents""")
def log_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4"""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.split("text", "\n").alias("log"))
    user = F.concat(F.lit("User "), "lang", F.lit(" not found"))
    return polls_ops.log_checks(
        docs,
        present={"has_at": "@", "has_lang": F.col("lang")},
        absent={"allowed": "Permission denied", "known_user": user},
    ).drop("log", "lang")


@query(f"SELECT id, state FROM {JOBS} WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def drop_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5"""
    removed = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    return record_ops.drop_removed(jobs(spark, sf_dir), removed).select("id", "state")


def _named_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "CASE WHEN p_size >= 10 THEN concat(p_name, '-', p_size) END AS name"
    )
    return parts.where("id % 2 = 0"), parts.where("id % 2 = 1")


PARTS = "(SELECT p_partkey AS id, CASE WHEN p_size >= 10 THEN p_name || '-' || p_size END AS name FROM part)"

# New jobs with the first known job of their name or else the first new one.
TAKEN = f"""(SELECT n.id, n.name, coalesce(k.first, nullif(min(n.id) OVER (PARTITION BY n.name), n.id)) AS taken_by
    FROM {PARTS} n LEFT JOIN (SELECT name, min(id) AS first FROM {PARTS} WHERE id % 2 = 1 GROUP BY name) k
    ON n.name = k.name WHERE n.id % 2 = 0)"""


@query(f"SELECT id, name, CASE WHEN name IS NULL THEN -1 ELSE coalesce(taken_by, -1) END AS taken_by FROM {TAKEN}")
def name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1"""
    found = record_ops.name_collisions(*_named_parts(spark, sf_dir))
    return found.withColumn("taken_by", F.coalesce("taken_by", F.lit(-1)))


@query(f"SELECT id, name FROM {TAKEN} WHERE name IS NULL OR taken_by IS NULL")
def accepted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new jobs that may go ahead."""
    return record_ops.accepted(*_named_parts(spark, sf_dir))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2"""
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return record_ops.known_ids(customers, table(spark, sf_dir, "orders"), "c_custkey", "o_custkey")


@query("""SELECT o_orderkey, o_custkey, o_custkey IN (SELECT s_suppkey FROM supplier) AS known
    FROM orders""")
def known_ids_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a flag, with a key that may be hot."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    suppliers = table(spark, sf_dir, "supplier")
    return record_ops.known_ids(
        orders, suppliers, "o_custkey", "s_suppkey", flag="known", spread_by="o_orderkey"
    )


@query("""WITH a AS (SELECT o_orderkey AS id, nullif(o_custkey % 5, 0) AS name, o_orderstatus AS state
        FROM orders WHERE o_orderkey % 10 <> 0),
    b AS (SELECT o_orderkey AS id, nullif(o_custkey % 5, 0) AS name,
        CASE WHEN o_orderkey % 7 = 0 THEN 'F' ELSE o_orderstatus END AS state
        FROM orders WHERE o_orderkey % 10 <> 1)
    SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed'
        WHEN a.name IS NOT DISTINCT FROM b.name AND a.state IS NOT DISTINCT FROM b.state THEN 'same'
        ELSE 'changed' END AS change FROM a FULL JOIN b ON a.id = b.id""")
def compare_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3"""
    return record_ops.compare_snapshots(*_snapshots(spark, sf_dir))


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "string(nullif(o_custkey % 5, 0)) AS name", "string(null) AS appId",
        "named_struct('driverLogUrl', string(null), 'sparkUiUrl', string(null)) AS appInfo",
        "o_orderstatus AS state",
    )
    later = orders.withColumn("state", F.expr("CASE WHEN id % 7 = 0 THEN 'F' ELSE state END"))
    return orders.where("id % 10 <> 0"), later.where("id % 10 <> 1")


@query(_ORACLE["compare_snapshots"])
def compare_stored_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 on tables bucketed by id, which are joined bucket by bucket."""
    before, after = _snapshots(spark, sf_dir)
    run = fresh_dir(spark, "x")[-32:]
    stored = [
        snapshots.write_snapshot(records, f"{name}_{run}", 8) for name, records in (("before", before), ("after", after))
    ]
    return record_ops.compare_snapshots(*stored)


def paged(start: int, size: int | None, key: str = "id", rows: str = JOBS) -> str:
    """A page in SQL; keys are unique."""
    end = "" if size is None else f"AND rank < {start + size}"
    return f"""SELECT {key}, state, rank, {start}::BIGINT AS "from", total FROM (SELECT *,
        row_number() OVER (ORDER BY {key}) - 1 AS rank, count(*) OVER () AS total FROM {rows})
        WHERE rank >= {start} {end}"""


@query(paged(100, 50))
def page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1"""
    return page_ops.page(jobs(spark, sf_dir), 100, 50).select("id", "state", "rank", "from", "total")


@query(paged(14_000, 700))
def page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: a page far from the front."""
    return page_ops.page(jobs(spark, sf_dir), 14_000, 700).select("id", "state", "rank", "from", "total")


@query(paged(1000, None))
def page_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: all rows behind an offset."""
    return page_ops.page(jobs(spark, sf_dir), 1000, 0).select("id", "state", "rank", "from", "total")


@query(paged(500, 250, "job", f"(SELECT 'job ' || id AS job, state FROM {JOBS})"))
def page_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: keys that are texts."""
    named = jobs(spark, sf_dir).withColumn("job", F.concat(F.lit("job "), "id"))
    found = page_ops.page(named, 500, 250, key="job")
    return found.select("job", "state", "rank", "from", "total")


# --- Logs -------------------------------------------------------------------------------------


@query(f"SELECT * FROM {first_seen_sql(DOC_POLLS)}")
def first_seen_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1"""
    seen = polls_ops.first_seen_lines(doc_polls(table(spark, sf_dir, "documents")))
    return seen.withColumn("pos", F.col("pos").cast("bigint"))


@query(f"SELECT batch_id, poll_seq, state FROM {until_terminal_sql(EVENT_POLLS)}")
def until_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2"""
    polls = event_polls(table(spark, sf_dir, "events"))
    return polls_ops.until_terminal(polls).select("batch_id", "poll_seq", "state")


@query(f"SELECT batch_id, poll_seq, pos, line FROM {first_seen_sql(until_terminal_sql(DOC_POLLS))}")
def follow_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 over W2: what following every job prints."""
    polls = polls_ops.until_terminal(doc_polls(table(spark, sf_dir, "documents")))
    return polls_ops.first_seen_lines(polls).withColumn("pos", F.col("pos").cast("bigint"))


@query(f"""SELECT batch_id, CAST(sum(len(lines)) AS BIGINT) AS total_lines, (SELECT count(DISTINCT line) FROM
        (SELECT batch_id AS b, unnest(lines) AS line FROM {until_terminal_sql(DOC_POLLS)}) WHERE b = p.batch_id)
        AS known_lines FROM {until_terminal_sql(DOC_POLLS)} p GROUP BY batch_id""")
def follow_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4"""
    polls = polls_ops.until_terminal(doc_polls(table(spark, sf_dir, "documents")))
    return polls_ops.follow_totals(polls.withColumn("total", F.size("lines")))


POLL_OUTCOME = f"""SELECT batch_id, arg_max(state, poll_seq) AS state,
    epoch_us(max(ts)) - epoch_us(min(ts)) AS elapsed_us,
    coalesce(epoch_us(max(ts) FILTER (state IN ('running', 'starting'))) - epoch_us(min(ts)), 0) AS active_us
    FROM {until_terminal_sql(EVENT_POLLS)} GROUP BY batch_id"""


@query(f"SELECT batch_id, state, elapsed_us, active_us > 60000000 AS timed_out FROM ({POLL_OUTCOME})")
def poll_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6"""
    polls = polls_ops.until_terminal(event_polls(table(spark, sf_dir, "events")))
    micros = (F.col("elapsed") * 1_000_000).cast("bigint").alias("elapsed_us")
    return polls_ops.poll_outcome(polls).select("batch_id", "state", micros, "timed_out")


@query(f"""SELECT batch_id, arg_min(appId, poll_seq) FILTER (appId IS NOT NULL) AS appId FROM
    (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY poll_seq) AS rn FROM {EVENT_POLLS})
    WHERE rn <= 11 GROUP BY batch_id""")
def first_app_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7"""
    return polls_ops.first_app_id(event_polls(table(spark, sf_dir, "events")))


@query("""SELECT doc_id, array_to_string(string_split(text, chr(10))[-10:], chr(10)) AS last_lines
    FROM documents""")
def tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2"""
    last = logs.tail(F.split("text", "\n"), 10)
    return table(spark, sf_dir, "documents").select("doc_id", joined(last).alias("last_lines"))


@query("""SELECT doc_id, array_to_string(string_split(text, chr(10))[3:5], chr(10)) AS some_lines,
    greatest(len(string_split(text, chr(10))) - 2, 0) AS n_rest, 0 AS n_none FROM documents""")
def log_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3"""
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        joined(logs.log_page(lines, 2, 3)).alias("some_lines"),
        F.size(logs.log_page(lines, 2)).cast("bigint").alias("n_rest"),
        F.size(logs.log_page(lines, 0, 0)).alias("n_none"),
    )


@query(f"""SELECT doc_id, CASE WHEN mark > 0 THEN array_to_string(log[1:mark - 1], chr(10)) END AS stdout,
    CASE WHEN mark > 0 THEN array_to_string(log[mark:], chr(10)) END AS stderr,
    CASE WHEN mark > 0 THEN 'ok' ELSE 'no_marker' END AS status
    FROM (SELECT *, coalesce(list_position(log, chr(10) || 'stderr: '), 0) AS mark FROM {DOC_LOGS})""")
def split_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1"""
    parts = doc_logs(spark, sf_dir).select("doc_id", logs.split_log("log").alias("part"))
    return parts.select(
        "doc_id",
        joined(F.col("part.stdout")).alias("stdout"),
        joined(F.col("part.stderr")).alias("stderr"),
        "part.status",
    )


@query(f"SELECT doc_id, array_to_string(log, chr(10)) AS rendered FROM {DOC_LOGS}")
def render_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11"""
    return doc_logs(spark, sf_dir).select("doc_id", logs.render_log("log").alias("rendered"))


# --- Configuration ----------------------------------------------------------------------------

LAYERS = """(SELECT o_custkey AS job_id, o_orderkey % 3 AS layer, o_orderkey AS seq, o_orderpriority AS key,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus || o_orderkey END AS value FROM orders)"""


@query(f"""SELECT job_id, key, value FROM (SELECT *, row_number() OVER
    (PARTITION BY job_id, key ORDER BY layer DESC, seq DESC) AS rn FROM {LAYERS}
    WHERE layer <> 2 OR value IS NOT NULL) WHERE rn = 1""")
def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5"""
    layers = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS job_id", "o_orderkey % 3 AS layer", "o_orderkey AS seq", "o_orderpriority AS key",
        "CASE WHEN o_orderkey % 7 <> 0 THEN concat(o_orderstatus, o_orderkey) END AS value",
    )
    return overlay_ops.overlay(layers)


@query("""SELECT o_orderkey AS job, '/user/svc/run/' || o_orderkey || '.py' AS file,
    CASE WHEN o_orderkey % 3 = 0 THEN '4g' WHEN o_orderkey % 5 <> 0 THEN '1000M' END AS driver_memory,
    CASE WHEN o_orderkey % 4 = 0 THEN '9' WHEN o_orderkey % 5 <> 0 THEN '2' END AS executor_cores,
    CASE WHEN o_orderkey % 7 = 0 THEN 'cli' WHEN o_orderkey % 3 = 0 THEN 'tool'
        WHEN o_orderkey % 5 <> 0 THEN 'notebook' END AS conf_a,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS conf_b,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS conf_c, 'true' AS log_conf FROM orders""")
def config_to_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two written fleets of configurations and command rows to request JSON."""
    orders = table(spark, sf_dir, "orders")
    conf = lambda *entries: ", ".join(f"'spark.{name}', {value}" for name, value in entries)
    notebook = F.expr(f"""to_json(named_struct('job', o_orderkey, 'session_configs', CASE WHEN o_orderkey % 5 <> 0
        THEN named_struct('driverMemory', '1000M', 'executorCores', 2, 'conf',
            map({conf(("a", "'notebook'"), ("b", "o_orderpriority"))})) END))""")
    tool = F.expr(f"""to_json(CASE WHEN o_orderkey % 3 = 0 THEN named_struct('job', string(o_orderkey),
        'driverMemory', '4g', 'conf', map({conf(("a", "'tool'"), ("c", "o_orderstatus"))}))
        ELSE named_struct('job', string(o_orderkey), 'driverMemory', null, 'conf', null) END)""")
    folders = fresh_dir(spark, "notebooks"), fresh_dir(spark, "tools")
    for folder, document in zip(folders, (notebook, tool)):
        orders.select(document.alias("value")).write.text(folder)

    job = lambda rows, document: rows.withColumn("job", F.get_json_object(document, "$.job").cast("bigint"))
    low = configs.config_rows(job(spark.read.text(folders[0]), "value"), "value", "job")
    middle = configs.tool_rows(job(spark.read.text(folders[1]), "value"), "value", "job")
    commands = orders.select(
        F.col("o_orderkey").alias("job"),
        F.expr("concat('hdfs:///jobs/', o_orderkey, '.py')").alias("file"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN 9 END").alias("executorCores"),
        F.expr("if(o_orderkey % 7 = 0, array('spark.a=cli'), cast(array() AS array<string>))").alias("items"),
    )
    layers = (
        configs.config_layer(low, "job")
        .unionByName(configs.tool_layer(middle, "job"))
        .unionByName(configs.command_layer(commands, "job", ["file", "executorCores"], "items"))
    )
    ready = request_ops.submissions(overlay_ops.overlay(layers))
    requests = request_ops.submission_requests(ready, F.lit("/user/svc/run"))
    got = lambda path: text.json_get("request", path)
    return requests.select(
        F.col("job_id").alias("job"),
        got("$.file").alias("file"),
        got("$.driverMemory").alias("driver_memory"),
        got("$.executorCores").alias("executor_cores"),
        *[got(f"$.conf['spark.{name}']").alias(f"conf_{name}") for name in "abc"],
        got("$.conf['spark.logConf']").alias("log_conf"),
    )


@query("""WITH entries AS (
        SELECT o_orderkey AS id, 0 AS layer, 'spark.a' AS key, o_orderstatus AS value FROM orders
        UNION ALL SELECT o_orderkey, 0, 'spark.b', o_orderpriority FROM orders
        UNION ALL SELECT o_orderkey, 1, 'spark.b', 'tool' FROM orders WHERE o_orderkey % 3 <> 0
        UNION ALL SELECT o_orderkey, 1, 'spark.c', o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0
        UNION ALL SELECT o_orderkey, 2, 'spark.a', 'cli' FROM orders WHERE o_orderkey % 5 = 0
        UNION ALL SELECT o_orderkey, 2, 'spark.logConf', 'false' FROM orders WHERE o_orderkey % 5 = 0
        UNION ALL SELECT o_orderkey, 3, 'spark.logConf', 'true' FROM orders)
    SELECT id, key, value FROM (SELECT *, row_number() OVER (PARTITION BY id, key ORDER BY layer DESC) AS rn
        FROM entries) WHERE rn = 1""")
def merge_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10"""
    layered = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "map('spark.a', o_orderstatus, 'spark.b', o_orderpriority) AS low",
        "CASE WHEN o_orderkey % 3 <> 0 THEN map('spark.b', 'tool', 'spark.c', o_orderstatus) END AS mid",
        "CASE WHEN o_orderkey % 5 = 0 THEN map('spark.a', 'cli', 'spark.logConf', 'false') END AS top",
    )
    # Never empty; the outer explode builds the map once, without a look at its size first.
    return layered.select("id", F.explode_outer(text.merge_conf("low", "mid", "top")).alias("key", "value"))


# --- Text -------------------------------------------------------------------------------------


@query("""SELECT c_custkey, replace(c_name, '#', '_') AS user_name FROM customer""")
def principal_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4"""
    principal = F.expr(
        "concat(replace(c_name, '#', '_'), CASE c_custkey % 3 WHEN 0 THEN '/host.example.com@EXAMPLE.COM'"
        " WHEN 1 THEN '@EXAMPLE.COM/x' ELSE '' END)"
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.principal_user(principal).alias("user_name")
    )


# Fixed value: what the mask and principal checks take for an address in a document.
ADDRESS = "[A-Za-z0-9._]+@[A-Za-z0-9.]+"


def first_address() -> Column:
    """The first address in a text, or null; only texts with an @ pay for the pattern."""
    found = F.when(F.contains("text", F.lit("@")), F.regexp_extract("text", ADDRESS, 0))
    return F.nullif(found, F.lit(""))



@query(f"""SELECT doc_id, nth, split_part(address, '@', 1) AS user_name FROM (SELECT doc_id,
    unnest(regexp_extract_all(text, '{ADDRESS}')) AS address,
    unnest(range(len(regexp_extract_all(text, '{ADDRESS}')))) AS nth FROM documents)""")
def principal_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """over every address of each document."""
    docs = table(spark, sf_dir, "documents").where(F.contains("text", F.lit("@")))
    found = docs.select(
        "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(ADDRESS), F.lit(0))).alias("nth", "address")
    )
    return found.select(
        "doc_id", F.col("nth").cast("bigint").alias("nth"), text.principal_user("address").alias("user_name")
    )


@query(f"""SELECT doc_id, CASE WHEN address = '' THEN text ELSE replace(text, address, '<<MASKED TOKEN>>') END
    AS masked FROM (SELECT doc_id, text, regexp_extract(text, '{ADDRESS}') AS address FROM documents)""")
def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the secret is the first address of the document, null where there is none."""
    masked = text.mask(F.col("text"), first_address())
    return table(spark, sf_dir, "documents").select("doc_id", masked.alias("masked"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'no_port' ELSE 'ok' END AS status,
    CASE WHEN page_id % 4 <> 0 THEN regexp_extract(url, '^([^/]*//[^/]*)', 1) END AS host,
    CASE WHEN page_id % 4 <> 0 THEN CAST(8000 + page_id AS VARCHAR) END AS port FROM pages""")
def split_host_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page hosts with a port; every fourth is a bare name without a colon."""
    address = F.expr(
        "CASE WHEN page_id % 4 = 0 THEN regexp_extract(url, '//([^/]*)', 1)"
        " ELSE concat(regexp_extract(url, '^([^/]*//[^/]*)', 1), ':', 8000 + page_id) END"
    )
    found = table(spark, sf_dir, "pages").select("page_id", text.split_host_port(address).alias("a"))
    return found.select("page_id", "a.host", "a.port", "a.status")


@query("""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'no_equals' ELSE 'ok' END AS status,
    CASE WHEN event_id % 10 <> 0 THEN user_id || '=' || event_id END AS typed,
    CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR) END AS k FROM events""")
def parse_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a value with an equals sign, a repeated key, and in every tenth event an item without one."""
    items = F.expr(
        "array(concat(event_type, '=', user_id, '=', event_id), 'k=1',"
        " concat('k', if(event_id % 10 = 0, '', '='), event_id))"
    )
    found = table(spark, sf_dir, "events").select("event_id", "event_type", text.parse_kv(items).alias("p"))
    return found.select(
        "event_id",
        "p.status",
        F.col("p.conf")[F.col("event_type")].alias("typed"),
        F.col("p.conf")["k"].alias("k"),
    )


@query("""SELECT json_merge_patch('{}', to_json({'file': 'hdfs:///' || o_orderkey,
        'name': CASE WHEN o_custkey % 5 <> 0 THEN 'job-' || o_custkey END,
        'driverCores': CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END,
        'queue': CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END,
        'args': CASE WHEN o_orderkey % 3 = 0 THEN CAST([] AS VARCHAR[]) ELSE [o_orderstatus] END}))::VARCHAR
    AS request FROM orders""")
def request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8"""
    fields = [
        F.expr(expression).alias(name)
        for name, expression in {
            "file": "concat('hdfs:///', o_orderkey)",
            "name": "CASE WHEN o_custkey % 5 <> 0 THEN concat('job-', o_custkey) END",
            "driverCores": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END",
            "queue": "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END",
            "args": "if(o_orderkey % 3 = 0, cast(array() AS array<string>), array(o_orderstatus))",
        }.items()
    ]
    return table(spark, sf_dir, "orders").select(text.request_json(*fields).alias("request"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, 'none' AS missing FROM events""")
def json_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9"""
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.json_get("props", "$.k").alias("k"),
        text.json_get("props", "$.a.b", "none").alias("missing"),
    )


# --- Artifacts --------------------------------------------------------------------------------

# What becomes of an archive in column ``uri``; no address has more than one fragment.
ARCHIVE = """CASE WHEN uri LIKE 'hdfs:%' THEN uri WHEN uri LIKE 'http:%' THEN NULL ELSE 'hdfs:///user/svc/run/'
    || regexp_extract(split_part(uri, '#', 1), '[^/]*$') ||
    CASE WHEN contains(uri, '#') THEN '#' || split_part(uri, '#', 2) ELSE '' END END"""

ENV_PYTHON = """'./' || CASE WHEN contains(uri, '#') THEN split_part(uri, '#', 2) ELSE
    regexp_extract(split_part(uri, '?', 1), '[^/]*$') END || '/bin/python'"""


def page_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.expr(URI).alias("uri"))


@query(f"""SELECT page_id, kind, CASE WHEN kind IN ('file', 'pyFile') THEN 'upload'
        WHEN uri LIKE 'hdfs:%' THEN 'pass' WHEN uri LIKE 'http:%' THEN 'reject' ELSE 'upload' END AS action,
    CASE kind WHEN 'file' THEN '/user/svc/run/' || regexp_extract(uri, '[^/]*$')
        WHEN 'pyFile' THEN 'hdfs:///user/svc/run/' || regexp_extract(uri, '[^/]*$')
        ELSE {ARCHIVE} END AS output
    FROM (SELECT page_id, {URI} AS uri, unnest(['file', 'env', 'archive', 'pyFile']) AS kind FROM pages)""")
def resolve_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every address as every kind of artifact."""
    kinds = F.array(*[F.lit(kind) for kind in ("file", "env", "archive", "pyFile")])
    rows = page_artifacts(spark, sf_dir).withColumn("kind", F.explode(kinds))
    found = artifacts.resolve_artifact("kind", "uri", F.lit("/user/svc/run"))
    return rows.select("page_id", "kind", found.alias("a")).select(
        "page_id", "kind", "a.action", "a.output"
    )


@query(f"SELECT page_id, {ENV_PYTHON} AS python FROM (SELECT page_id, {URI} AS uri FROM pages)")
def env_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3"""
    return page_artifacts(spark, sf_dir).select("page_id", artifacts.env_python("uri").alias("python"))


@query(f"""SELECT page_id, CASE WHEN {ARCHIVE} IS NULL THEN uri ELSE '' END AS rejected,
    CASE WHEN {ARCHIVE} IS NOT NULL THEN '/user/svc/run/main.py' END AS file,
    CASE WHEN {ARCHIVE} IS NULL THEN NULL
        WHEN page_id % 2 = 0 THEN '["hdfs:///user/svc/run/libs.zip#LIBS"]'
        WHEN uri LIKE 'hdfs:%' THEN '["' || uri || '","hdfs:///user/svc/run/libs.zip#LIBS"]'
        ELSE '["hdfs:///user/svc/run/libs.zip#LIBS","' || {ARCHIVE} || '"]' END AS archives,
    CASE WHEN {ARCHIVE} IS NOT NULL AND page_id % 2 = 1 THEN {ENV_PYTHON} END AS python,
    CASE WHEN {ARCHIVE} IS NOT NULL THEN 'true' END AS log_conf,
    CASE WHEN {ARCHIVE} IS NOT NULL THEN '[]' END AS args
    FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '' ELSE {URI} END AS uri FROM pages)""")
def submission_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, F3, F8, F10 together: odd pages name a packed environment."""
    submissions = table(spark, sf_dir, "pages").select(
        "page_id",
        F.lit("/home/u/main.py").alias("file"),
        F.expr("CASE WHEN page_id % 3 = 0 THEN concat('page-', page_id) END").alias("name"),
        F.lit("2g").alias("driverMemory"),
        F.lit(None).cast("int").alias("driverCores"),
        F.lit(None).cast("string").alias("executorMemory"),
        F.lit(2).alias("executorCores"),
        F.lit(None).cast("int").alias("numExecutors"),
        F.array(F.lit("/home/u/libs.zip#LIBS")).alias("archives"),
        F.lit(None).cast("string").alias("queue"),
        F.expr("CASE WHEN page_id % 4 = 0 THEN map('spark.logConf', 'false') END").alias("conf"),
        F.array().cast("array<string>").alias("args"),
        F.lit(None).cast("array<string>").alias("pyFiles"),
        F.expr(f"CASE WHEN page_id % 2 = 1 THEN {URI} END").alias("conda_env"),
    )
    requests = request_ops.submission_requests(submissions, F.lit("/user/svc/run"))
    return requests.select(
        "page_id",
        F.array_join("rejected", ",").alias("rejected"),
        text.json_get("request", "$.file").alias("file"),
        text.json_get("request", "$.archives").alias("archives"),
        text.json_get("request", "$.conf['spark.pyspark.python']").alias("python"),
        text.json_get("request", "$.conf['spark.logConf']").alias("log_conf"),
        text.json_get("request", "$.args").alias("args"),
    )


# --- Jobs on the workers ----------------------------------------------------------------------


@query("""SELECT hits, n, round(4.0 * hits / n, 9) AS ratio FROM (SELECT count(*) FILTER
    (x * x + y * y <= 1) AS hits, count(*) AS n FROM (SELECT
    ((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 10007) / 10007.0::DOUBLE * 2 - 1 AS x,
    ((l_orderkey * 6007 + l_suppkey * 331 + l_partkey * 17 + l_linenumber * 101) % 10009)
        / 10009.0::DOUBLE * 2 - 1 AS y FROM lineitem))""")
def mc_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: points hashed from line items, so that both engines draw the same ones."""
    points = table(spark, sf_dir, "lineitem").select(
        F.expr(
            "((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 10007) / 10007.0D * 2 - 1"
        ).alias("x"),
        F.expr(
            "((l_orderkey * 6007 + l_suppkey * 331 + l_partkey * 17 + l_linenumber * 101) % 10009)"
            " / 10009.0D * 2 - 1"
        ).alias("y"),
    )
    return sampling.mc_ratio(points).withColumn("ratio", F.round("ratio", 9))


@query("SELECT 3 AS parts, count(*)::BIGINT AS elements, true AS every_slice, true AS few FROM events")
def worker_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the lines name machines, so what is compared is how many elements they have seen in all
    and that the slices, run at once, were all seen by no more workers than there are slices."""
    slots = spark.sparkContext.defaultParallelism
    events = table(spark, sf_dir, "events").select("event_id")
    found = sampling.worker_inventory(events, slices=slots, together=True)
    return found.agg(
        F.max(F.size(F.split("info", ","))).alias("parts"),
        F.sum("elements").alias("elements"),
        (F.sum("slices") == slots).alias("every_slice"),
        (F.count(F.lit(1)) <= slots).alias("few"),
    )


@query("SELECT count(*)::BIGINT AS elements, 0 AS incomplete FROM events")
def worker_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element is seen by a worker that names host, interpreter and library."""
    facts = sampling.worker_facts(table(spark, sf_dir, "events").select("event_id"))
    complete = F.size(F.split("info", ",")) == 3
    return facts.agg(
        F.sum("elements").alias("elements"), F.count_if(~complete).cast("int").alias("incomplete")
    )


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM events GROUP BY 1")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3"""
    counts = sampling.daily_counts(table(spark, sf_dir, "events"), "ts")
    return counts.withColumn("day", F.col("day").cast("string"))


# --- Streams: the same answers as the batch forms, in several micro-batches ---------------------


#: Bytes of polls in a file of a stream, about.
FILE_BYTES = 64_000_000


def stream(spark: SparkSession, polls: DataFrame, label: str, order: str = "poll_seq") -> DataFrame:
    """The polls as files in the order of polls, which a stream takes a third at a time."""
    path = fresh_dir(spark, label)
    size = polls.agg(F.sum(F.octet_length(F.struct("*").cast("string")))).first()[0] or 0
    number = 3 * max(1, math.ceil(size / 3 / FILE_BYTES))
    # The hash deals out polls of one place in the order.
    ranges = polls.repartitionByRange(number, order, F.xxhash64(*polls.columns))
    ranges.sortWithinPartitions(order).write.parquet(path)
    files = len(spark.read.schema(polls.schema).parquet(path).inputFiles())
    return spark.readStream.schema(polls.schema).option("maxFilesPerTrigger", math.ceil(files / 3)).parquet(path)


@query(f"SELECT batch_id, poll_seq, pos, line FROM {first_seen_sql(until_terminal_sql(DOC_POLLS))}")
def follow_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1"""
    polls = stream(spark, doc_polls(table(spark, sf_dir, "documents")), "doc-polls")
    found = follow.follow_stream(polls, fresh_dir(spark, "follow"))
    return found.withColumn("pos", F.col("pos").cast("bigint"))


STDOUT_POLLS = f"""(SELECT source AS batch_id, doc_id AS poll_seq,
    CASE WHEN doc_id % 101 = 100 THEN 'success' ELSE 'running' END AS state,
    CASE WHEN mark > 0 THEN log[1:mark - 1] ELSE [] END AS lines FROM (SELECT d.*, l.log,
    coalesce(list_position(l.log, chr(10) || 'stderr: '), 0) AS mark
    FROM documents d JOIN {DOC_LOGS} l USING (doc_id)))"""


def stdout_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls with the part of their log before the stderr header."""
    split = doc_logs(spark, sf_dir).select("doc_id", logs.split_log("log")["stdout"].alias("lines"))
    polls = doc_polls(table(spark, sf_dir, "documents")).drop("lines")
    return polls.join(split.withColumnRenamed("doc_id", "poll_seq"), "poll_seq").select(
        "batch_id", "poll_seq", "state", "lines"
    )


@query(f"SELECT batch_id, poll_seq, pos, line FROM {first_seen_sql(until_terminal_sql(STDOUT_POLLS))}")
def follow_stdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, W2, W1 in a row: what following every job prints of its stdout."""
    polls = polls_ops.until_terminal(stdout_polls(spark, sf_dir))
    return polls_ops.first_seen_lines(polls).withColumn("pos", F.col("pos").cast("bigint"))


@query(f"SELECT batch_id, poll_seq, pos, line FROM {first_seen_sql(until_terminal_sql(STDOUT_POLLS))}")
def follow_stdout_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream."""
    polls = stream(spark, stdout_polls(spark, sf_dir), "stdout-polls")
    found = follow.follow_stream(polls, fresh_dir(spark, "follow-stdout"))
    return found.withColumn("pos", F.col("pos").cast("bigint"))


@query(f"SELECT batch_id, poll_seq, state FROM {until_terminal_sql(EVENT_POLLS)}")
def follow_until_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2"""
    polls = event_polls(table(spark, sf_dir, "events")).select("batch_id", "poll_seq", "state")
    return follow.follow_until_terminal(stream(spark, polls, "polls"), fresh_dir(spark, "latch"))


@query(f"SELECT batch_id, active_us AS waited_us FROM ({POLL_OUTCOME}) WHERE active_us > 60000000")
def stuck_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each job's polls come in order, as its watch takes them; files are read by their age."""
    whole = event_polls(table(spark, sf_dir, "events"))
    path = fresh_dir(spark, "timed-polls")
    edges = [float("-inf"), *whole.approxQuantile("poll_seq", [1 / 3, 2 / 3], 0.01), float("inf")]
    for low, high in zip(edges, edges[1:]):
        part = whole.where((F.col("poll_seq") > low) & (F.col("poll_seq") <= high))
        part.coalesce(1).write.mode("append").parquet(path)
    polls = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(path)
    waited = (F.col("waited") * 1_000_000).cast("bigint").alias("waited_us")
    found = follow.stuck_jobs(polls, fresh_dir(spark, "stuck")).where("NOT silent")
    return found.select("batch_id", waited)


# --- Contract ---------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Every distinct log line of every job once, where it first appeared."""
    return first_seen_lines(spark, "/root/testdata/sf0.001")


def training_text() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the operators on training text; empty where these are not installed."""
    try:
        import corpus_pipeline
        from jobledger.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "jobledger.llm"):
            raise
        return {}, {}
    found, sql = dict(llm.QUERIES), dict(llm.ORACLE_SQL)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Query]:
    return _QUERIES | training_text()[0]


def oracle_sql() -> dict[str, str]:
    return _ORACLE | training_text()[1]
