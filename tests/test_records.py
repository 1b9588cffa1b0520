import pytest

from jobledger.operators import pages
from jobledger.operators import records as ops
from jobledger.schemas import JOB_RECORD
from jobledger.sources.records import job_listing, job_records, record_table

NONE = (None, None)


def job(id, name=None, app=None, info=NONE, log=(), state="starting"):
    return (id, name, app, info, list(log), state)


@pytest.fixture
def jobs(rows):
    return lambda *data: rows(list(data), JOB_RECORD)


def ids(df, key="id"):
    return sorted(row[key] for row in df.collect())


def test_listing_keeps_the_last_of_equal_ids(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"from": 0, "total": 3, "sessions": [{"id": 7, "state": "starting", "log": [], "extra": 1,'
        ' "appInfo": {"driverLogUrl": null, "sparkUiUrl": "u"}}, {"id": 8, "state": "dead"}]}\n'
        '{"from": 2, "total": 3, "sessions": [{"id": 7, "state": "success", "name": "n"}]}\n'
    )
    assert job_listing(spark, str(tmp_path)).count() == 3
    found = {row.id: row for row in job_records(spark, str(tmp_path)).collect()}
    assert (found[7].state, found[7].name, found[7].listing_pos) == ("success", "n", 2)
    assert found[8].state == "dead" and found[8].appInfo is None


def test_a_later_listing_wins_wherever_its_records_stand(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"from": 0, "snap": 2, "sessions": [{"id": 2, "state": "success"}]}\n')
    (tmp_path / "a.json").write_text(
        '{"from": 0, "snap": 1, "sessions": [{"id": 1, "state": "dead"}, {"id": 2, "state": "running"}]}\n'
    )
    found = {r.id: r.state for r in job_records(spark, str(tmp_path), arrival="snap").collect()}
    assert found == {1: "dead", 2: "success"}


def test_record_table(spark, jobs, tmp_path):
    path = str(tmp_path / "t")
    jobs(job(1, log=["stdout: "])).write.json(path)
    assert record_table(spark, path, "json").first().log == ["stdout: "]


def test_latest_of_many_copies(spark):
    copies = spark.range(1000).selectExpr("id % 2 AS id", "id AS arrival")
    assert sorted(ops.latest_records(copies, "arrival").collect()) == [(0, 998), (1, 999)]


def test_lookup(jobs, rows):
    known = jobs(job(1, state="dead"), job(2))
    asked = rows([(1,), (3,), (1,)], "id long")
    found = {r.id: (r.found, r.state) for r in ops.lookup(known, asked).collect()}
    assert found == {1: (True, "dead"), 3: (False, None)}
    with pytest.raises(Exception, match="no such job: 3"):
        ops.lookup(known, asked, strict=True).collect()


def test_states_and_active(jobs):
    known = jobs(job(1, state="running"), job(2, state="success"), job(3), job(4, state="odd"))
    assert ops.states(known, 2).collect() == [(2, "success")]
    assert ops.states(known).count() == 4
    assert ids(ops.active(known)) == [1, 3]


def test_drop_removed(jobs, rows):
    removed = rows([(2,), (2,), (9,)], "id long")
    assert ids(ops.drop_removed(jobs(job(1), job(2)), removed)) == [1]


def in_order(page, key="id"):
    return [(row["rank"], row[key]) for row in page.orderBy("rank").collect()]


def test_page_defaults_and_limits(jobs):
    known = jobs(*[job(i) for i in (5, 3, 9, 1)])
    assert in_order(pages.page(known, 1, 2)) == [(1, 3), (2, 5)]
    assert in_order(pages.page(known, 0, 0)) == in_order(pages.page(known)) == [(0, 1), (1, 3), (2, 5), (3, 9)]
    assert in_order(pages.page(known, 3)) == [(3, 9)]
    assert in_order(pages.page(known, 4, 2)) == []
    assert in_order(pages.page(known.limit(0))) == []
    row = pages.page(known, 1, 2).first()
    assert (row["from"], row.total) == (1, 4)


@pytest.mark.parametrize("start,size", [(0, 5), (2, 4), (9, 10), (13, None), (0, None), (40, 3)])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_page_equals_sorted_slice(rows, kind, start, size):
    values = [None, None, *[(k * k * 2**40) - 5 for k in range(18)], 11, 11, 11]
    keys = [None if k is None or kind == "long" else str(k) for k in values] if kind == "string" else values
    df = rows([(k, "same") for k in keys], f"id {kind}, name string").repartition(5)
    order = sorted(keys, key=lambda k: (k is not None, k if k is not None else 0))
    end = None if size is None else start + size
    assert in_order(pages.page(df, start, size)) == list(enumerate(order))[start:end]


@pytest.mark.parametrize("hot_keys", [None, 100])
def test_name_collisions(jobs, hot_keys):
    known = jobs(job(4, "a"), job(2, "a"), job(3, ""), job(5))
    new = jobs(job(10, "a"), job(11, ""), job(12), job(13, "b"), job(14, "a"), job(15, "b"), job(16))
    found = {r.id: r.taken_by for r in ops.name_collisions(new, known, hot_keys=hot_keys).collect()}
    assert found == {10: 2, 11: 3, 12: None, 13: None, 14: 2, 15: 13, 16: None}
    assert ids(ops.accepted(new, known, hot_keys=hot_keys)) == [12, 13, 16]


def test_first_in_listing_order(rows):
    known = rows([(4, "a", 0), (2, "a", 1)], "id long, name string, pos int")
    new = rows([(1, "a", 0)], "id long, name string, pos int")
    assert ops.name_collisions(new, known, order="pos").first().taken_by == 4


def test_known_ids(rows):
    listing = rows([(1,), (1,), (2,)], "id long")
    asked = rows([(1, 0), (3, 1), (1, 2), (None, 3)], "job long, n int")
    assert ids(ops.known_ids(asked, listing, "job"), "n") == [0, 2]
    assert ids(ops.known_ids(asked, listing, "job", spread_by="n"), "n") == [0, 2]
    for spread_by in (None, "n"):
        flagged = ops.known_ids(asked, listing, "job", flag="known", spread_by=spread_by)
        assert {r.n: r.known for r in flagged.collect()} == {0: True, 1: False, 2: True, 3: False}


def test_compare_snapshots(jobs):
    before = jobs(job(1, log=["x"]), job(2, "n"), job(3), job(5, info=(None, "u")))
    after = jobs(job(1, log=["y"]), job(2), job(4), job(5, info=(None, "v")))
    found = {r.id: r.change for r in ops.compare_snapshots(before, after).collect()}
    assert found == {1: "same", 2: "changed", 3: "removed", 4: "added", 5: "changed"}
