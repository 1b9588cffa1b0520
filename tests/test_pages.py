"""Pages partition their input exactly, whatever its rows are and however they are dealt."""

import random

import pytest
from pyspark.sql import functions as F

from jobledger.operators import pages

SCHEMA = """id long, name string, log array<string>, conf map<string,string>, info struct<url:string, tags:map<string,int>>,
    rank_ int"""


def nested(rows, n, ids=1):
    """Records that differ in nested columns alone, by a null and its place too."""
    random_ = random.Random(n)
    data = []
    for i in range(n):
        log = random_.choice([None, [], ["a", None], [None, "a"], ["a"], [f"line {i}"]])
        conf = random_.choice([None, {}, {"k": None}, {"k": f"{i}", "l": "x"}])
        info = random_.choice([None, (None, None), ("u", {"t": i}), (None, {"t": 1})])
        data.append((random_.randrange(ids), random_.choice([None, "n"]), log, conf, info, None))
    return rows(data, SCHEMA)


def shown(found):
    return sorted(str(row.asDict(recursive=True)) for row in found.drop("rank", "from", "total").collect())


@pytest.mark.parametrize("ids", [1, 3])
def test_pages_are_a_partition_of_the_rows(rows, ids):
    records = nested(rows, 60, ids).unionByName(nested(rows, 20, ids)).unionByName(nested(rows, 20, ids))
    read, ranks = [], []
    for place, start in enumerate(range(0, 100, 15)):
        found = pages.page(records.repartition(3 + place), start, 15)
        assert found.columns == [*records.columns, "rank", "from", "total"]
        rows_ = found.collect()
        assert {row.total for row in rows_} == {100} and {row["from"] for row in rows_} == {start}
        ranks += [row["rank"] for row in rows_]
        read += [str(row.asDict(recursive=True)) for row in found.drop("rank", "from", "total").collect()]
    assert sorted(ranks) == list(range(100))
    assert sorted(read) == sorted(str(row.asDict(recursive=True)) for row in records.collect())


def test_an_index_gives_the_same_pages(rows, spark):
    records = nested(rows, 80, 30)
    index = pages.PageIndex.write(records, key="id")
    again = pages.PageIndex.open(spark, index.path)
    assert again.total == index.total == 80
    for start, size in [(0, 7), (7, 40), (70, 20), (75, None), (None, None), (90, 5)]:
        assert shown(again.page(start, size)) == shown(pages.page(records, start, size))


def test_a_page_reads_the_ranges_it_needs(rows, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = pages.PageIndex.write(spark.range(10_000).withColumn("name", F.col("id").cast("string")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(index.slabs) > 4
    found = index.page(5000, 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_slab" in plan and "LessThanOrEqual(_slab" in plan
    assert sorted(row.id for row in found.collect()) == list(range(5000, 5020))
    needed = [slab for slab, before, n in index.slabs if before < 5020 and before + n > 5000]
    assert len(needed) <= 2


def test_equal_rows_and_no_rows(rows):
    records = rows([(None, "x")] * 5000 + [(1, "y")], "id long, name string")
    found = pages.page(records, 4990, 20).orderBy("rank").collect()
    assert [row["rank"] for row in found] == list(range(4990, 5001)) and found[-1].id == 1
    assert pages.page(records.limit(0)).collect() == []
    assert pages.PageIndex.write(records.limit(0)).page(0, 5).collect() == []
